"""Whole texts to token ids by the tokenizers library, memoised by chunk."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from itertools import islice

import public_tokenizers

DEFAULT_VOCAB = "byte_bpe_50k.json"
#: Unicode White_Space, which is what the pre-tokenizer's \s matches.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters of which a run is a piece of its own wherever one of _STOPS or white space follows.
_LETTERS, _STOPS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", ".,:;!?|()"
_CHUNK = re.compile(f" ?[{_LETTERS}]++(?![^{_WS}{_STOPS}])| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Longer chunks are encoded each time, and this many are remembered.
_LONG, _REMEMBERED = 48, 1_000_000


class ChunkEncoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    A byte-level pre-tokenizer starts a new piece at every chunk (one optional space and a run without
    white space, or white space; letters before a stop are a chunk without it), and merges never cross
    pieces, so a text's ids are its chunks' ids in order. Chunks repeat a lot; each goes through the library once. A vocabulary with another
    pre-tokenizer or a normalizer, and any text that contains an added token, is encoded whole.
    """

    def __init__(self, vocab_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocab_path)
        with open(vocab_path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.chunked = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.memo: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        a = array(self.code, ids)
        if sys.byteorder == "big":
            a.byteswap()
        return a.tobytes()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``width`` bytes."""
        out: list[bytes | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self.chunked or any(a in t for a in self.added)]
        for i, ids in zip(whole, self._encode_all([texts[i] for i in whole])):
            out[i] = ids
        if len(self.memo) > _REMEMBERED:
            # the first half came early, so it is the commoner
            self.memo = dict(islice(self.memo.items(), _REMEMBERED // 2))
        memo = self.memo
        todo, size = [], 0
        for i, text in enumerate(texts):
            if out[i] is None:
                todo.append((i, _CHUNK.findall(text)))
                size += len(text)
            if todo and (size > 1 << 20 or i == len(texts) - 1):
                new = list(set().union(*[c for _, c in todo]).difference(memo))
                memo.update(zip(new, self._encode_all(new)))
                for k, chunks in todo:
                    out[k] = b"".join(map(memo.__getitem__, chunks))
                for c in new:
                    if len(c) > _LONG:
                        del memo[c]
                todo, size = [], 0
        return out


_encoders: dict[str, ChunkEncoder] = {}


def encoder(vocab_path: str) -> ChunkEncoder:
    """This worker's encoder for a vocabulary, made once."""
    if vocab_path not in _encoders:
        _encoders[vocab_path] = ChunkEncoder(vocab_path)
    return _encoders[vocab_path]


def default_vocab() -> str:
    return public_tokenizers.path(DEFAULT_VOCAB)
