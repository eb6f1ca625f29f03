"""The corpus-preparation plan: stages declared one by one, run by Spark as one query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.plain import normalized, over_bytes
from millrace.functions.text import is_blank
from millrace.operators.annotate import BaseAnnotator
from millrace.operators.dedup import arrival_order, dedup_keep_first
from millrace.operators.filters import MAX_GRADE, filter_by_keywords, filter_by_readability, require_column
from millrace.operators.stats import StageCounts
from millrace.operators.synonyms import SynonymMapper
from millrace.sources import io

_ORDER, _NORMAL = "__mr_arrival", "__mr_normal"


@dataclass(frozen=True)
class Plan:
    """An immutable plan; each method gives a plan with one more stage.

    Order of work: normalize and drop empty texts, filters as added, synonyms, keep-first dedup,
    annotators. ``early_dedup`` also drops repeats right after normalizing, so that fewer rows are
    scored: equal texts share their verdicts, and the later dedup, which synonyms make necessary,
    gives the same rows.
    """

    text_column: str = "text"
    normalize: bool = True
    dedup: bool = True
    early_dedup: bool = False
    filters: tuple[tuple[str, Any], ...] = ()
    mapper: SynonymMapper | None = None
    annotators: tuple[Any, ...] = ()

    def with_keywords(self, keywords: Sequence[str], literal: bool = False) -> Plan:
        return replace(self, filters=(*self.filters, ("keywords", (tuple(keywords), literal)))) if keywords else self

    def with_readability(self, max_grade: float = MAX_GRADE) -> Plan:
        return replace(self, filters=(*self.filters, ("readability", max_grade)))

    def with_synonyms(self, mapper: SynonymMapper | Mapping[str, str]) -> Plan:
        return replace(self, mapper=mapper if isinstance(mapper, SynonymMapper) else SynonymMapper(mapper))

    def with_annotator(self, annotator: Any) -> Plan:
        return replace(self, annotators=(*self.annotators, annotator))

    def _filtered(self, df: DataFrame, counts: StageCounts | None) -> DataFrame:
        for i, (kind, arg) in enumerate(self.filters):
            df = filter_by_keywords(df, arg[0], self.text_column, arg[1]) if kind == "keywords" else filter_by_readability(df, arg, self.text_column)
            df = counts.watch(df, f"filter {i + 1}: {kind}") if counts else df
        return df

    def apply(self, df: DataFrame, order: Column | None = None, counts: StageCounts | None = None) -> DataFrame:
        """The prepared table, lazily. ``order`` says which of equal texts is first (default: arrival)."""
        require_column(df, self.text_column)
        columns, text = df.columns, F.col(f"`{self.text_column}`")
        df = counts.watch(df, "input") if counts else df
        if self.dedup:
            df = df.withColumn(_ORDER, order if order is not None else arrival_order())
        if self.normalize:
            # a generator keeps Catalyst from copying the call into every filter that follows
            normal = over_bytes(text, normalized, pa.string(), "string")
            once = df.select("*", F.explode(F.array(normal)).alias(_NORMAL))
            df = once.withColumn(self.text_column, F.col(_NORMAL)).drop(_NORMAL).where(F.length(text) > 0)
            df = counts.watch(df, "normalized") if counts else df
            if self.dedup and self.early_dedup:
                df = dedup_keep_first(df, self.text_column, F.col(_ORDER))
        df = self._filtered(df, counts)
        if self.mapper:
            df = df.withColumn(self.text_column, self.mapper.column(text))
        if self.dedup:
            df = dedup_keep_first(df, self.text_column, F.col(_ORDER)).select(*[F.col(f"`{c}`") for c in columns])
            df = counts.watch(df, "deduplicated") if counts else df
        for annotator in self.annotators:
            df = annotator.annotate_dataframe(df, self.text_column)
        return df

    def stream(self, df: DataFrame) -> DataFrame:
        """The stateless stages on a streaming frame: all but dedup and Python annotators."""
        if self.dedup or any(isinstance(a, BaseAnnotator) for a in self.annotators):
            raise ValueError("a stream takes plans without dedup and Python annotators; see millrace.streaming")
        return self.apply(df)


@dataclass
class DataPipeline:
    """A plan under construction: ``add_*`` change it and return it."""

    text_column: str = "text"
    normalize: bool = True
    dedup: bool = True
    plan: Plan = field(init=False)
    counts: StageCounts | None = field(init=False, default=None)

    def __post_init__(self) -> None:
        self.plan = Plan(self.text_column, self.normalize, self.dedup)

    def add_keyword_filter(self, keywords: Sequence[str]) -> DataPipeline:
        self.plan = self.plan.with_keywords(keywords)
        return self

    def add_readability_filter(self, max_grade: float = MAX_GRADE) -> DataPipeline:
        self.plan = self.plan.with_readability(max_grade)
        return self

    def add_synonym_mapper(self, mapping: Mapping[str, str] | None = None, mapping_path: str | None = None) -> DataPipeline:
        """A map goes before a path to one; a later call replaces an earlier one."""
        if mapping or mapping_path:
            self.plan = self.plan.with_synonyms(mapping or SynonymMapper.from_json(mapping_path))
        return self

    def add_annotator(self, annotator: Any) -> DataPipeline:
        self.plan = self.plan.with_annotator(annotator)
        return self

    def process(self, df: DataFrame) -> DataFrame:
        """The prepared table; after an action on it, ``stage_counts()`` has the rows of each stage."""
        self.counts = StageCounts()
        return self.plan.apply(df, counts=self.counts)

    def stage_counts(self) -> dict[str, int]:
        return self.counts.read() if self.counts else {}


def process_corpus(
    input_path: str, output_path: str, *, spark: SparkSession | None = None, generate_stats: bool = True, dedup: bool = True, normalize: bool = True,
    keywords: Sequence[str] | None = None, max_grade: float | None = MAX_GRADE, annotators: Sequence[Any] | None = None,
    synonyms_map_path: str | None = None, synonyms_map: Mapping[str, str] | None = None, text_column: str = "text",
) -> dict[str, Any]:
    """Read, prepare and write a corpus; returns its statistics, or {} without them.

    Keywords go before the readability filter, which is on unless ``max_grade`` is None.
    """
    df = io.spread(io.read_parquet(input_path, text_column, spark, order=True))
    plan = Plan(text_column, normalize, dedup, early_dedup=True).with_keywords(list(keywords or ()))
    if max_grade is not None:
        plan = plan.with_readability(max_grade)
    if synonyms_map or synonyms_map_path:
        plan = plan.with_synonyms(synonyms_map or SynonymMapper.from_json(synonyms_map_path))
    for a in annotators or ():
        plan = plan.with_annotator(a)
    result = plan.apply(df, order=F.col(io.ORDER)).drop(io.ORDER)
    if generate_stats:
        return io.write_parquet_with_stats(result, output_path, text_column)
    io.write_parquet(result, output_path)
    return {}


def blank_rows(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Rows whose text is null or blank."""
    return df.where(is_blank(F.col(text_column)))
