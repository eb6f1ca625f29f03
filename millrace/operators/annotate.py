"""Annotators: columns added by native expressions, Python callables or a language-model client."""

from __future__ import annotations

import json
import os
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Mapping
from typing import Any, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions.text import number_of_characters, number_of_words

TOPICS = tuple((
    "Arts & Humanities;Business & Finance;Children entertainment;Computer Science;"
    "Consumer Experiences & Personal Finance;Daily Routines & Home Management;Education Studies;"
    "Engineering & Technology;Environmental Science & Sustainability;Family & Interpersonal Relationships;"
    "Food & Culinary;Health & Medicine;History & Archaeology;Hobbies, Leisure & Entertainment;"
    "Languages & Linguistics;Law & Legal Studies;Life Sciences;Mathematics;Personal Health, Wellness & Lifestyle;"
    "Personal Journeys & Life Events;Physical Sciences;Social Sciences;Work Life & Career"
).split(";"))
EDUCATION_LEVELS = tuple("primary school;middle school;high school;university degree;PhD degree".split(";"))
MODEL, MOST_CHARACTERS = "gemini-2.5-flash-lite", 15_000
#: A worker holds the annotations of so many rows.
PART_ROWS = 100
#: Types that Arrow takes from Python values as they are.
_PLAIN = (T.StringType, T.BooleanType, T.BinaryType, T.IntegralType, T.FloatType, T.DoubleType)
Annotated = Callable[[Iterable[str | None]], list[dict[str, Any]]]


def _schema(spec: str | T.StructType) -> T.StructType:
    return spec if isinstance(spec, T.StructType) else T.StructType.fromDDL(spec)


def _in_parts(start: Callable[[], None], annotated: Annotated, schema: pa.Schema, safe: bool) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """The annotations as structs, PART_ROWS at a time; values become Arrow's as a pandas UDF would make them."""

    def column(values: list[Any], kind: pa.DataType) -> pa.Array:
        try:
            return pa.array(values, kind, from_pandas=True, safe=safe)
        except pa.ArrowInvalid:
            return pa.array(values, from_pandas=True).cast(kind, safe=safe)

    def part(texts: pa.Array) -> pa.Array:
        rows = annotated(t.as_py() for t in texts)
        return pa.StructArray.from_arrays([column([r.get(f.name) for r in rows], f.type) for f in schema], fields=list(schema))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        start()
        for texts in batches:
            for at in range(0, max(1, len(texts)), PART_ROWS):
                yield part(texts.slice(at, PART_ROWS))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _in_batches(start: Callable[[], None], annotated: Annotated, names: list[str]) -> Callable[[Iterator[Any]], Iterator[Any]]:
    """The annotations as frames, a batch at a time."""
    import pandas as pd

    def run(batches: Iterable[pd.Series]) -> Iterable[pd.DataFrame]:
        start()
        for texts in batches:
            rows = annotated(None if t is None or t is pd.NA else t for t in texts)
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype="object") for n in names})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return run


class BaseAnnotator(ABC):
    """One text (maybe null) in, a value for each column of ``output_schema`` out.

    Set ``output_schema`` (a StructType or DDL string); without it the columns are inferred from the
    first ``sample_rows`` rows on the driver, and a later row with another key raises.
    """

    output_schema: str | T.StructType | None = None
    sample_rows = 20

    @abstractmethod
    def annotate(self, text: str | None) -> Mapping[str, Any]: ...

    def open(self) -> None:
        """Called once in each task before its first text, for clients and models."""

    def schema_for(self, df: DataFrame, text_column: str) -> T.StructType:
        if self.output_schema is not None:
            return _schema(self.output_schema)
        self.open()
        rows = [dict(self.annotate(r[0])) for r in df.select(text_column).limit(self.sample_rows).collect()]
        if not rows:
            raise ValueError("an empty table has nothing to infer output columns from: set output_schema")
        return df.sparkSession.createDataFrame(rows).schema

    def annotate_dataframe(self, df: DataFrame, text_column: str = "text", show_progress: bool = False) -> DataFrame:
        """``df`` and the annotation columns, row by row in Arrow batches; a name that is taken raises.

        Where the columns are text, numbers, booleans and bytes, a worker holds one batch as Arrow has it, one text
        as a string and the annotations of ``PART_ROWS`` rows; other types go through pandas, a batch at a time.
        """
        schema = self.schema_for(df, text_column)
        if clash := {f.name.lower() for f in schema} & {c.lower() for c in df.columns}:
            raise ValueError(f"annotation columns are in the table already: {sorted(clash)}")
        names, inferred = schema.fieldNames(), self.output_schema is None

        def annotated(texts: Iterable[str | None]) -> list[dict[str, Any]]:
            rows = [self.annotate(t) for t in texts]
            if inferred and (unknown := set().union(*rows).difference(names)):
                raise ValueError(f"keys that the first {self.sample_rows} rows lack: {sorted(unknown)}; set output_schema")
            return rows

        c = F.col(f"`{text_column}`")
        if all(isinstance(f.dataType, _PLAIN) for f in schema):
            safe = df.sparkSession.conf.get("spark.sql.execution.pandas.convertToArrowArraySafely") == "true"
            added = F.arrow_udf(_in_parts(self.open, annotated, to_arrow_schema(schema), safe), schema).asNondeterministic()(c)
        else:
            added = F.pandas_udf(_in_batches(self.open, annotated, names), schema).asNondeterministic()(c)
        rows = df.withColumn("__mr_note", added)
        return rows.select(*[F.col(f"`{c}`") for c in df.columns], "__mr_note.*")


class CustomFunctionAnnotator(BaseAnnotator):
    """Wraps a callable."""

    def __init__(self, func: Callable[[str | None], Mapping[str, Any]], output_schema: str | T.StructType | None = None) -> None:
        self.func, self.output_schema = func, output_schema

    def annotate(self, text: str | None) -> Mapping[str, Any]:
        return self.func(text)


class ExpressionAnnotator:
    """Columns from native expressions: no Python runs at all."""

    def __init__(self, expressions: Callable[[Column], Mapping[str, Column]]) -> None:
        self.expressions = expressions

    def annotate_dataframe(self, df: DataFrame, text_column: str = "text", show_progress: bool = False) -> DataFrame:
        added = self.expressions(F.col(f"`{text_column}`"))
        if clash := {n.lower() for n in added} & {c.lower() for c in df.columns}:
            raise ValueError(f"annotation columns are in the table already: {sorted(clash)}")
        return df.select("*", *[c.alias(n) for n, c in added.items()])


def text_features(c: Column) -> dict[str, Column]:
    """word_count, char_count, sentence_count (at least 1), avg_word_length (one decimal), has_numbers, has_question."""
    words = number_of_words(c)
    letters = F.length(F.regexp_replace(c, r"\s+", "")).cast("double")
    return {
        "word_count": words, "char_count": number_of_characters(c), "sentence_count": F.greatest(F.regexp_count(c, F.lit("[.!?]")), F.lit(1)).cast("long"),
        "avg_word_length": F.when(words > 0, F.round(letters / words, 1)).otherwise(0.0), "has_numbers": c.rlike("[0-9]"), "has_question": c.contains("?"),
    }


def parse_response(raw: str, topics: Iterable[str] = TOPICS, levels: Iterable[str] = EDUCATION_LEVELS) -> dict[str, str | None]:
    """topic and education from a model's reply, fenced or bare; a value outside its domain is null.

    Raises json.JSONDecodeError for what isn't JSON, other errors for JSON that isn't an object.
    """
    body = raw.strip().removeprefix("```json").removesuffix("```").strip()
    found = json.loads(body).get
    return {name: value if (value := found(name)) in allowed else None for name, allowed in (("topic", tuple(topics)), ("education", tuple(levels)))}


class LLMAnnotator(BaseAnnotator):
    """Topic and education level by a language model.

    ``client_factory`` makes a callable from prompt to reply, once a task; failures give sentinels by
    class: ``Error: JSON Decode``, ``Error: API Value``, ``Error: API Call``. One request at a time runs
    in a task, so partitions bound the concurrency. A null text has null labels without a request, a blank
    one too if ``skip_blank``.
    """

    output_schema = "topic string, education string"

    def __init__(self, client_factory: Callable[[], Callable[[str], str]], max_text_length: int = MOST_CHARACTERS, skip_blank: bool = True) -> None:
        self.client_factory, self.max_text_length, self.skip_blank = client_factory, max_text_length, skip_blank
        self._client: Callable[[str], str] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_client": None}

    def open(self) -> None:
        self._client = self.client_factory()

    def prompt(self, text: str) -> str:
        most = self.max_text_length
        text = text if len(text) <= most else f"{text[:most]}..."
        return (
            f'Name the main topic of a text and the education its reader needs.\n\nText:\n"{text}"\n\nTopics, choose one: {list(TOPICS)}\n'
            f'Education, choose one: {list(EDUCATION_LEVELS)}\nReply with this JSON object alone: {{"topic": "...", "education": "..."}}'
        )

    def annotate(self, text: str | None) -> dict[str, str | None]:
        if text is None or (self.skip_blank and not text.strip()):
            return dict.fromkeys(("topic", "education"))
        if self._client is None:
            self.open()
        try:
            return parse_response(self._client(self.prompt(text)))
        except json.JSONDecodeError:
            error = "Error: JSON Decode"
        except ValueError:
            error = "Error: API Value"
        except Exception:
            error = "Error: API Call"
        return {"topic": error, "education": error}


class GeminiAnnotator(LLMAnnotator):
    """LLMAnnotator over the google-generativeai client; key from the argument, GOOGLE_API_KEY or MY_API_KEY."""

    def __init__(self, api_key: str | None = None, model_name: str = MODEL, max_text_length: int = MOST_CHARACTERS, temperature: float = 0.1, max_output_tokens: int = 50) -> None:
        try:
            import google.generativeai  # noqa: F401
        except ImportError:
            raise ImportError("GeminiAnnotator needs the google-generativeai package") from None
        key = next(filter(None, (api_key, *map(os.getenv, ("GOOGLE_API_KEY", "MY_API_KEY")))), None)
        if not key:
            raise ValueError("no API key: pass api_key or set GOOGLE_API_KEY")

        def factory() -> Callable[[str], str]:
            import google.generativeai as genai

            genai.configure(api_key=key)
            settings = {"max_output_tokens": max_output_tokens, "temperature": temperature}
            model = genai.GenerativeModel(model_name)
            return lambda prompt: model.generate_content(prompt, generation_config=settings).text

        super().__init__(factory, max_text_length)
