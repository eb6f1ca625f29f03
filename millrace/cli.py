"""Command line: ``python -m millrace.cli corpus|vocabulary|ingest``."""

from __future__ import annotations

import argparse
import sys
import traceback
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

_CORPUS = (
    ("input", str, None, "Parquet with a text column"), ("output", str, None, "where the prepared Parquet goes"), ("text-column", str, "text", "its name"),
    ("synonyms", str, None, "JSON object of words and replacements"), ("keywords", str, None, "comma-separated; any of them keeps a text"),
    ("max-grade", float, 8.0, "highest reading grade"), ("no-max-grade", bool, False, "no readability filter"), ("no-normalize", bool, False, "texts as they are"),
    ("no-dedup", bool, False, "keep repeated texts"), ("no-stats", bool, False, "no statistics file"), ("api-key", str, None, "for --annotate"),
    ("gemini-model", str, "gemini-2.5-flash-lite", "model for --annotate gemini"),
)
_VOCABULARY = (
    ("cefr_csv", str, None, "CSV with headword and CEFR"), ("out_dir", str, None, "where the map goes"), ("easy_levels", str, "A1,A2", "levels of easy words"),
    ("difficult_levels", str, "B2,C1,C2", "levels of words to replace"), ("include_b1", bool, False, "B1 is difficult too"),
    ("allow_multiword", bool, False, "phrases may replace words"), ("min_alpha_only", bool, False, "only words of ASCII letters"),
    ("thesaurus", str, None, "Parquet or CSV with word, synonym, freq"), ("no_wordnet", bool, False, "no thesaurus"),
)
_INGEST = (
    ("source", str, None, "wikipedia: extracted JSON lines; fineweb: Parquet shards"), ("input-dir", str, None, "folder that holds them"), ("output-dir", str, "data/raw", "folder for the result"),
    ("num-files", int, 1, "shards to combine"), ("start-index", int, 0, "first shard"), ("skip-existing", bool, False, "keep an output that is complete"), ("date", str, "", "a label for the output"),
)
_REQUIRED = {"input", "output", "cefr_csv", "out_dir", "source", "input-dir"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    commands = top.add_subparsers(dest="command", required=True)
    for name, table in (("corpus", _CORPUS), ("vocabulary", _VOCABULARY), ("ingest", _INGEST)):
        p = commands.add_parser(name)
        for flag, kind, default, text in table:
            extra = {"action": "store_true"} if kind is bool else {"type": kind, "default": default, "required": flag in _REQUIRED}
            p.add_argument(f"--{flag}", help=text, **extra)
        if name == "corpus":
            p.add_argument("--annotate", choices=("gemini",))
    return top


def split_keywords(text: str | None) -> list[str]:
    return [k for k in map(str.strip, (text or "").split(",")) if k]


def _corpus(a: argparse.Namespace, spark: SparkSession) -> None:
    from millrace.operators.annotate import GeminiAnnotator
    from millrace.plans.pipeline import process_corpus

    annotators = [GeminiAnnotator(a.api_key, a.gemini_model)] if a.annotate else None
    found = process_corpus(
        a.input, a.output, text_column=a.text_column, normalize=not a.no_normalize, keywords=split_keywords(a.keywords), max_grade=None if a.no_max_grade else a.max_grade,
        synonyms_map_path=a.synonyms, annotators=annotators, dedup=not a.no_dedup, generate_stats=not a.no_stats, spark=spark,
    )
    print(f"{a.output}: {found.get('total_rows', '?')} rows")


def _vocabulary(a: argparse.Namespace, spark: SparkSession) -> None:
    from millrace.plans.vocabulary import build_vocabulary, parse_levels
    from millrace.sources.mappings import CEFRIndex

    thesaurus = None
    if a.thesaurus and not a.no_wordnet:
        thesaurus = spark.read.parquet(a.thesaurus) if a.thesaurus.endswith(".parquet") else spark.read.csv(a.thesaurus, header=True, schema="word string, synonym string, freq long")
    built = build_vocabulary(
        CEFRIndex.from_csv(a.cefr_csv, spark), thesaurus, parse_levels(a.easy_levels), parse_levels(a.difficult_levels), a.include_b1, a.allow_multiword, a.min_alpha_only
    )
    print(f"{a.out_dir}: {built.write(a.out_dir)}")


def _ingest(a: argparse.Namespace, spark: SparkSession) -> None:
    from millrace.sources import io

    if a.source == "wikipedia":
        output = str(Path(a.output_dir) / f"wikipedia{'_' + a.date if a.date else ''}.parquet")
        if not (a.skip_existing and io.is_written(output)):
            io.write_parquet(io.read_wiki_jsonl(a.input_dir, spark), output)
    elif a.source == "fineweb":
        output = io.combine_shards(io.shard_paths(a.input_dir, a.start_index, a.num_files), str(Path(a.output_dir) / "fineweb_combined.parquet"), spark, a.skip_existing)
    else:
        raise ValueError(f"unknown source: {a.source}")
    print(output)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well, 1 on an error, 130 if interrupted."""
    a = parser().parse_args(argv)
    try:
        {"corpus": _corpus, "vocabulary": _vocabulary, "ingest": _ingest}[a.command](a, spark or SparkSession.builder.appName("millrace").getOrCreate())
    except KeyboardInterrupt:
        return 130
    except Exception:
        traceback.print_exc()
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
