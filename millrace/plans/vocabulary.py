"""From a CEFR word list to a synonym map: manual pairs, then a thesaurus, then base forms."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import is_alpha, lemma
from millrace.sources.mappings import DIFFICULT, EASY, CEFRIndex, level_of
from millrace.sources.staging import open_output, stage, write_file

#: Easy word: formal words for it.
SEED = {
    "about": "approximately", "ask": "inquire", "before": "prior", "best": "optimal", "buy": "purchase", "change": "modify", "choose": "select",
    "end": "terminate", "enough": "sufficient", "get": "obtain", "have": "possess", "help": "assist assistance facilitate", "helping": "assistive",
    "later": "subsequently", "live": "reside", "lower": "decrease", "many": "numerous", "need": "require", "next": "subsequent",
    "often": "commonly frequently", "raise": "increase", "reduce": "diminish", "see": "observe perceive", "show": "demonstrate illustrate indicate",
    "so": "consequently therefore", "start": "commence", "still": "nevertheless", "tell": "inform", "try": "attempt endeavor endeavour",
    "understand": "comprehend", "use": "utilize",
}


def seed_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w, easy) for easy, words in SEED.items() for w in words.split()], "src string, dst string")


def manual_pairs(seed: DataFrame, ranks: DataFrame, easy: DataFrame) -> DataFrame:
    """Seed pairs (src, dst) whose source is in the list and whose target is easy."""
    known = seed.join(ranks.select(F.col("headword").alias("src")), "src", "left_semi")
    return known.join(easy.select(F.col("headword").alias("dst")), "dst", "left_semi").select("src", "dst")


@dataclass(frozen=True)
class ClassThesaurus:
    """A thesaurus by classes: each of ``words`` (word, class) has all ``synonyms`` (class, synonym, freq) of its classes.

    Says the same as their join, which grows with the product of a class's words and synonyms.
    """

    words: DataFrame
    synonyms: DataFrame

    def pairs(self) -> DataFrame:
        return self.words.join(self.synonyms, "class").select("word", "synonym", "freq")


def best_synonyms(targets: DataFrame, easy: DataFrame, thesaurus: DataFrame | ClassThesaurus, allow_multiword: bool = False) -> DataFrame:
    """(src, dst): of a word's easy synonyms (word, synonym, freq) that of least rank, then most frequent, shortest, first.

    Of a class only its two best synonyms are looked at: the order doesn't depend on the word, and the
    word itself is at most one of them.
    """
    by_class = isinstance(thesaurus, ClassThesaurus)
    pairs = thesaurus.synonyms if by_class else thesaurus.withColumnRenamed("word", "src").withColumn("src", F.lower("src"))
    key = "class" if by_class else "src"
    rows = pairs.select(key, F.lower(F.replace("synonym", F.lit("_"), F.lit(" "))).alias("dst"), "freq")
    if not allow_multiword:
        rows = rows.where(~F.col("dst").contains(" "))
    known = targets.select(F.col("headword").alias("src"))
    if not by_class:
        rows = rows.where(F.col("src") != F.col("dst")).join(known, "src", "left_semi")
    rows = rows.join(easy.select(F.col("headword").alias("dst"), "rank"), "dst")
    order = F.struct("rank", (-F.coalesce("freq", F.lit(0))).alias("f"), F.length("dst").alias("n"), "dst")
    if by_class:
        once = rows.groupBy("class", "dst").agg(F.min(order).alias("way"))
        two = once.withColumn("k", F.row_number().over(Window.partitionBy("class").orderBy("way"))).where("k <= 2").drop("k", "dst")
        words = thesaurus.words.select(F.lower("word").alias("src"), "class").join(known, "src", "left_semi")
        rows = words.join(two, "class").where(F.col("src") != F.col("way.dst"))
        order = F.col("way")
    return rows.groupBy("src").agg(F.min(order)["dst"].alias("dst"))


def base_forms(targets: DataFrame, easy: DataFrame) -> DataFrame:
    """(src, dst): words whose base form is another, easy word."""
    rows = targets.select(F.col("headword").alias("src"), lemma(F.col("headword")).alias("dst")).where("src <> dst")
    return rows.join(easy.select(F.col("headword").alias("dst")), "dst", "left_semi").select("src", "dst")


@dataclass(frozen=True)
class Vocabulary:
    """``mapping``: from, to, source (manual, wordnet or lemma_fallback), from_cefr, to_cefr; ``unmapped``: headword."""

    mapping: DataFrame
    unmapped: DataFrame
    targets: DataFrame
    options: dict

    def report(self) -> dict[str, int]:
        """Targets, mapped words (manual ones may lie outside the targets), and targets left unmapped."""
        return {"targets": self.targets.count(), "mapped": self.mapping.count(), "unmapped": self.unmapped.count()}

    def write(self, directory: str) -> dict[str, int]:
        """synonyms.json, synonyms.csv, unmapped.txt and build_stats.txt at a path or URI.

        Single files in order, so by the driver, which holds one partition of the sorted rows at a time.
        """
        out = str(directory).rstrip("/")
        found = {"targets": self.targets.count(), "mapped": 0, "unmapped": 0}
        with open_output(f"{out}/synonyms.json") as words, open_output(f"{out}/synonyms.csv", newline="") as lines:
            table = csv.writer(lines)
            table.writerow(self.mapping.columns)
            words.write("{")
            for r in self.mapping.orderBy("from").toLocalIterator():
                pair = f"{json.dumps(r['from'], ensure_ascii=False)}: {json.dumps(r['to'], ensure_ascii=False)}"
                words.write(("," if found["mapped"] else "") + "\n  " + pair)
                table.writerow([x or "" for x in r])
                found["mapped"] += 1
            words.write("\n}" if found["mapped"] else "}")
        with open_output(f"{out}/unmapped.txt") as left:
            for r in self.unmapped.orderBy("headword").toLocalIterator():
                left.write(f"{r['headword']}\n")
                found["unmapped"] += 1
        share = 100 * found["mapped"] / found["targets"] if found["targets"] else 0
        lines = {
            "Total difficult targets": found["targets"], "Mapped": f"{found['mapped']} ({share:.2f}%)", "Unmapped": found["targets"] - found["mapped"],
            "Targets without a mapping": found["unmapped"], **self.options,
        }
        write_file(f"{out}/build_stats.txt", "".join(f"{k}: {v}\n" for k, v in lines.items()))
        return found


def build_vocabulary(
    index: CEFRIndex, thesaurus: DataFrame | ClassThesaurus | None = None, easy_levels: Sequence[str] = EASY, difficult_levels: Sequence[str] = DIFFICULT,
    include_b1: bool = False, allow_multiword: bool = False, min_alpha_only: bool = False, seed: DataFrame | None = None,
) -> Vocabulary:
    """Map difficult words to easy ones; a manual pair goes before a synonym, and that before a base form.

    The recorded source is the true one.
    """
    levels = [*difficult_levels, *(["B1"] if include_b1 and "B1" not in difficult_levels else [])]
    ranks, easy = index.ranks, index.easy(easy_levels)
    targets = index.difficult(levels).where("headword <> 'a'")
    if min_alpha_only:
        targets = targets.where(is_alpha(F.col("headword")))
    spark = ranks.sparkSession
    ways = [(manual_pairs(seed if seed is not None else seed_frame(spark), ranks, easy), "manual", 0), (base_forms(targets, easy), "lemma_fallback", 2)]
    if thesaurus is not None:
        ways.append((best_synonyms(targets, easy, thesaurus, allow_multiword), "wordnet", 1))
    all_ways = None
    for pairs, source, order in ways:
        rows = pairs.select("src", F.struct(F.lit(order).alias("o"), "dst", F.lit(source).alias("source")).alias("way"))
        all_ways = rows if all_ways is None else all_ways.unionByName(rows)
    # staged: two joins and the unmapped words read it
    best = stage(all_ways.groupBy("src").agg(F.min("way").alias("way")), "ways")
    named = best.select(F.col("src").alias("from"), F.col("way.dst").alias("to"), F.col("way.source").alias("source"))
    mapping = (
        named.join(ranks.select(F.col("headword").alias("from"), level_of(F.col("rank")).alias("from_cefr")), "from", "left")
        .join(ranks.select(F.col("headword").alias("to"), level_of(F.col("rank")).alias("to_cefr")), "to", "left")
        .select(*"from to source from_cefr to_cefr".split())
    )
    unmapped = targets.select("headword").join(named.select(F.col("from").alias("headword")), "headword", "left_anti")
    options = {"WordNet used": thesaurus is not None, "Easy levels": ", ".join(easy_levels), "Difficult levels": ", ".join(levels)}
    return Vocabulary(mapping, unmapped, targets, options)


def parse_levels(text: str | Iterable[str]) -> list[str]:
    parts = text.split(",") if isinstance(text, str) else text
    return [p.strip().upper() for p in parts if p.strip()]
