"""The registered queries of the training-data operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op4_bpe_encoding
from .fingerprint import op6_document_fingerprints
from .html import op8_html_extraction
from .media import op1_media_columns
from .mixing import op10_source_mix
from .neardup import op7_minhash_near_dedup
from .quality import op3_quality_classifier
from .tokenfile import op9_token_file
from .tokens import op2_token_counts
from .warc import OP5_SQL, op5_warc_archive

ALL = (
    op1_media_columns,
    op2_token_counts,
    op3_quality_classifier,
    op4_bpe_encoding,
    op5_warc_archive,
    op6_document_fingerprints,
    op7_minhash_near_dedup,
    op8_html_extraction,
    op9_token_file,
    op10_source_mix,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    return {"op5_warc_archive": OP5_SQL}
