"""Word maps and CEFR word lists."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable
from io import StringIO
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import normalize_token, strip
from millrace.scalar import CEFR_ORDER
from millrace.scalar import normalize_token as scalar_token
from millrace.sources.staging import read_file

#: Levels of easy words and of words to replace, unless a caller names others.
EASY, DIFFICULT = ("A1", "A2"), ("B2", "C1", "C2")


def load_mapping(path: str) -> dict[str, str]:
    """A word map from .json (kept whole) or .csv.

    CSV columns are those headed from and to, else the first two, whose first row still counts as a
    header. Short rows, empty sides and identities are left out; of equal words the last row wins.
    """
    kind = Path(path).suffix.lower()
    if kind == ".json":
        return {scalar_token(str(k)): scalar_token(str(v)) for k, v in json.loads(read_file(str(path))).items()}
    if kind != ".csv":
        raise ValueError(f"neither .json nor .csv: {path}")
    rows = iter(csv.reader(StringIO(read_file(str(path)), newline="")))
    header = [scalar_token(h) for h in next(rows, [])]
    a, b = (header.index("from"), header.index("to")) if {"from", "to"} <= set(header) else (0, 1)
    pairs = [(scalar_token(r[a]), scalar_token(r[b])) for r in rows if len(r) > max(a, b)]
    return {k: v for k, v in pairs if k and v and k != v}


def rank_of(level: Column) -> Column:
    """A CEFR level's rank from 0 (A1) to 5 (C2); null for anything else."""
    up = F.upper(strip(level))
    return F.coalesce(*[F.when(up == name, rank) for name, rank in CEFR_ORDER.items()])


def level_of(rank: Column) -> Column:
    return F.coalesce(*[F.when(rank == r, name) for name, r in CEFR_ORDER.items()])


def cefr_ranks(words: DataFrame, headword: str = "headword", level: str = "CEFR") -> DataFrame:
    """(headword, rank): the least rank of each lower-cased word; blank words and unknown levels are left out."""
    rows = words.select(normalize_token(F.col(headword)).alias("headword"), rank_of(F.col(level)).alias("rank"))
    return rows.where((F.col("headword") != "") & F.col("rank").isNotNull()).groupBy("headword").agg(F.min("rank").alias("rank"))


class CEFRIndex:
    """A word list with ranks, as a DataFrame; the word methods look one word up."""

    def __init__(self, ranks: DataFrame) -> None:
        self.ranks = ranks

    @classmethod
    def from_csv(cls, path: str, spark: SparkSession | None = None) -> CEFRIndex:
        """A CSV with headword and CEFR columns, named in any case."""
        spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        df = spark.read.csv(path, header=True)
        by_name = {scalar_token(c): c for c in df.columns}
        if not {"headword", "cefr"} <= set(by_name):
            raise ValueError(f"no headword and CEFR columns in {path}: {df.columns}")
        return cls(cefr_ranks(df.select(F.col(f"`{by_name['headword']}`").alias("headword"), F.col(f"`{by_name['cefr']}`").alias("CEFR"))))

    def rank(self, word: str) -> int | None:
        row = self.ranks.where(F.col("headword") == scalar_token(word)).first()
        return None if row is None else row["rank"]

    def is_easy(self, word: str, levels: Iterable[str] = EASY) -> bool:
        rank = self.rank(word)
        return rank is not None and rank <= max(CEFR_ORDER[x] for x in levels)

    def is_difficult(self, word: str, levels: Iterable[str] = DIFFICULT) -> bool:
        rank = self.rank(word)
        return rank is not None and rank >= min(CEFR_ORDER[x] for x in levels)

    def easy(self, levels: Iterable[str] = EASY) -> DataFrame:
        """Words up to the highest of the levels."""
        return self.ranks.where(F.col("rank") <= max(CEFR_ORDER[x] for x in levels))

    def difficult(self, levels: Iterable[str] = DIFFICULT) -> DataFrame:
        """Words from the lowest of the levels on."""
        return self.ranks.where(F.col("rank") >= min(CEFR_ORDER[x] for x in levels))

    def flagged(self, easy: Iterable[str] = EASY, difficult: Iterable[str] = DIFFICULT) -> DataFrame:
        """(headword, is_easy, is_difficult): each word once, by its rank alone."""
        most, least = max(CEFR_ORDER[x] for x in easy), min(CEFR_ORDER[x] for x in difficult)
        return self.ranks.select("headword", (F.col("rank") <= most).alias("is_easy"), (F.col("rank") >= least).alias("is_difficult"))


def read_wordnet(directory: str, spark: SparkSession | None = None) -> DataFrame:
    """(word, synonym, freq): the pairs of each synset in WordNet's database files, for ``best_synonyms``.

    Synsets are the lines of data.noun, data.verb, data.adj and data.adv; freq is the synonym's count over its
    senses in index.sense (0 where it has none). A synset has at most 255 words, so its pairs are bounded.
    """
    spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def lines(pattern: str) -> DataFrame:
        # the licence's lines at the head of a file start with spaces
        return spark.read.option("pathGlobFilter", pattern).text(directory).where(~F.col("value").startswith("  ")).select(F.split("value", " ").alias("f"))

    synsets = lines("data.*").select("f", F.conv(F.col("f")[3], 16, 10).cast("int").alias("n"))
    # words stand at every second place from the fifth on; adjectives may have a marker in brackets
    plain = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.lower(F.regexp_replace(F.get(F.col("f"), i * 2 + 4), r"\([a-z]+\)$", "")))
    words = synsets.select(F.monotonically_increasing_id().alias("synset"), F.col("f")[2].alias("kind"), plain.alias("words"))
    pairs = words.select(F.explode("words").alias("word"), "words").select("word", F.explode("words").alias("synonym")).where("word <> synonym").distinct()
    senses = lines("index.sense").select(F.lower(F.split(F.col("f")[0], "%")[0]).alias("synonym"), F.col("f")[3].cast("long").alias("c"))
    freq = senses.groupBy("synonym").agg(F.sum("c").alias("freq"))
    clean = [F.replace(c, F.lit("_"), F.lit(" ")).alias(c) for c in ("word", "synonym")]
    return pairs.join(freq, "synonym", "left").select(*clean, F.coalesce("freq", F.lit(0)).cast("long").alias("freq"))
