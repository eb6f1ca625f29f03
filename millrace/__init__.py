"""A PySpark-native engine for preparing text corpora.

Names are loaded when first used, so that workers import no more than they run.
"""

from importlib import import_module

_PLACES = {
    "millrace.plans.pipeline": "DataPipeline Plan process_corpus",
    "millrace.plans.vocabulary": "build_vocabulary Vocabulary",
    "millrace.operators.annotate": "BaseAnnotator CustomFunctionAnnotator ExpressionAnnotator LLMAnnotator GeminiAnnotator",
    "millrace.operators.filters": "filter_by_readability filter_by_keywords",
    "millrace.operators.dedup": "dedup_keep_first",
    "millrace.operators.synonyms": "SynonymMapper rewrite_by_join",
    "millrace.operators.stats": "generate_stats value_counts top_values",
    "millrace.sources.io": "read_parquet write_parquet write_parquet_with_stats read_wiki_jsonl read_shards combine_shards",
    "millrace.sources.mappings": "CEFRIndex load_mapping",
    "millrace.scalar": "is_middle_school_level normalize_text preserve_case_like tokenize_basic detokenize_basic simple_lemma_like",
}
_HOME = {name: module for module, names in _PLACES.items() for name in names.split()}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(_HOME[name]), name)
