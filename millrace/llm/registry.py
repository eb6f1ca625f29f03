"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .queries_classifier import op7_factorisation_machine
from .queries_licenses import op2_license_automaton
from .queries_media import op6_chunked_media
from .queries_mixing import OP8_SQL, op8_systematic_mix
from .queries_packing import op4_residual_packing
from .queries_quality import op5_tokenizer_fertility
from .queries_secrets import op9_assignment_lexer
from .queries_sharding import OP1_SQL, op1_histogram_shards
from .queries_simhash import op10_simhash_bktree
from .queries_tokens import op3_token_planes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_histogram_shards, op2_license_automaton, op3_token_planes, op4_residual_packing, op5_tokenizer_fertility,
        op6_chunked_media, op7_factorisation_machine, op8_systematic_mix, op9_assignment_lexer, op10_simhash_bktree,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_histogram_shards": OP1_SQL, "op8_systematic_mix": OP8_SQL}
