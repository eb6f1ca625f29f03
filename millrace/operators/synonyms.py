"""Word-level synonym rewriting by three strategies that give the same text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Mapping
from os import PathLike

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.plain import if_ascii, swapper
from millrace.functions.text import WORD, preserve_case
from millrace.scalar import preserve_case_like
from millrace.sources.staging import read_file

#: Up to so many entries the rewrite is a native expression; a map literal is searched entry by entry.
NATIVE_ENTRIES = 16
_PIECE = rf"{WORD}|[^\p{{L}}\p{{N}}_]+"
_WORD_RE = re.compile(r"\w+")
Words = Mapping[str, str]


class SynonymMapper:
    """An immutable map of words to replacements, both lower-cased.

    Each maximal word (letters, digits, underscores) is looked up once, lower-cased; a hit that isn't
    empty replaces it, in its case if ``preserve_case``. All else stays as it is.
    """

    def __init__(self, mapping: Words | None = None, preserve_case: bool = True) -> None:
        self.preserve_case = preserve_case
        self.mapping = {word.lower(): new.lower() for word, new in dict(mapping or ()).items()}

    @classmethod
    def from_json(cls, path: str | PathLike, preserve_case: bool = True) -> SynonymMapper:
        return cls(json.loads(read_file(str(path))), preserve_case)

    def with_entry(self, synonym: str, canonical: str) -> SynonymMapper:
        return SynonymMapper({**self.mapping, synonym: canonical}, self.preserve_case)

    def add(self, synonym: str, canonical: str) -> SynonymMapper:
        """Add an entry in place; prefer ``with_entry``."""
        self.mapping.update({synonym.lower(): canonical.lower()})
        return self

    def simplify_line(self, s: str) -> str:
        """One string rewritten on the driver or in a worker."""
        if not self.mapping:
            return s

        def swap(m: re.Match) -> str:
            hit = self.mapping.get(m[0].lower())
            return (preserve_case_like(m[0], hit) if self.preserve_case else hit) if hit else m[0]

        return _WORD_RE.sub(swap, s)

    def simplify_iter(self, texts: Iterable[str], /) -> Iterator[str]:
        """Each of the strings rewritten."""
        return map(self.simplify_line, texts)

    def column(self, c: Column) -> Column:
        """The rewritten text: by an Arrow UDF that carries the map.

        For a small map only texts of ASCII characters go there, where one pattern finds its words; the rest is rewritten natively.
        """
        if not self.mapping:
            return c
        if len(self.mapping) > NATIVE_ENTRIES:
            return self.arrow_column(c)
        swap = swapper(self.mapping, preserve_case_like if self.preserve_case else lambda word, hit: hit)
        return if_ascii(c, swap, pa.string(), "string", self.native_column(c))

    def native_column(self, c: Column) -> Column:
        # pieces between words are looked up too, so keys without a word's character stay out
        words = [kv for kv in self.mapping.items() if _WORD_RE.search(kv[0])]
        if not words:
            return c
        table = F.create_map(*[F.lit(x) for kv in words for x in kv])

        def swap(piece: Column) -> Column:
            hit = F.try_element_at(table, F.lower(piece))
            new = preserve_case(piece, hit) if self.preserve_case else hit
            return F.when(F.length(hit) > 0, new).otherwise(piece)

        return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0)), swap), "")

    def arrow_column(self, c: Column) -> Column:
        mapper = SynonymMapper(self.mapping, self.preserve_case)

        def rewrite(texts: pa.Array) -> pa.Array:
            return pa.array([None if t is None else mapper.simplify_line(t) for t in texts.to_pylist()], pa.string())

        rewrite.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        return F.arrow_udf(rewrite, "string")(c)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.mapping.items()), "word string, canonical string")


def rewrite_by_join(df: DataFrame, mapping: DataFrame, key: str, text_column: str = "text", preserve: bool = True) -> DataFrame:
    """(key, text) rewritten by joining its pieces with a table (word, canonical) of any size.

    Keys must be unique. The map is broadcast only if the planner knows it to be small. Texts without
    a piece (empty, null) stay.
    """
    pieces = df.select(key, F.posexplode(F.regexp_extract_all(text_column, F.lit(_PIECE), F.lit(0))).alias("pos", "piece"))
    words = mapping.select(F.col("word").alias("w"), F.col("canonical").alias("hit"))
    found = pieces.join(words, F.lower("piece") == F.col("w"), "left")
    new = preserve_case(F.col("piece"), F.col("hit")) if preserve else F.col("hit")
    swapped = found.select(key, "pos", F.when(F.length("hit") > 0, new).otherwise(F.col("piece")).alias("piece"))
    joined = swapped.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("__mr_text"))
    return df.select(key, text_column).join(joined, key, "left").select(key, F.coalesce("__mr_text", text_column).alias(text_column))


def canonical_by_synset(synsets: DataFrame) -> DataFrame:
    """(synset_order, lemma_order, lemma) -> (word, canonical): each lemma to the first of its synset; the first synset wins."""
    lemma = F.lower(F.replace("lemma", F.lit("_"), F.lit(" ")))
    rows = synsets.select("synset_order", "lemma_order", lemma.alias("lemma"))
    heads = rows.groupBy("synset_order").agg(F.min_by("lemma", "lemma_order").alias("canonical"))
    pairs = rows.join(heads, "synset_order").where(F.col("lemma") != F.col("canonical"))
    return pairs.groupBy(F.col("lemma").alias("word")).agg(F.min_by("canonical", F.struct("synset_order", "lemma_order")).alias("canonical"))
