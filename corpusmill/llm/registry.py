"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.ann import op2_ann
from corpusmill.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from corpusmill.llm.licenses import op9_licenses
from corpusmill.llm.line_dedup import OP4_SQL, op4_line_dedup
from corpusmill.llm.mixing import OP10_SQL, op10_mixing
from corpusmill.llm.near_dedup import OP5_SQL, op5_near_dedup
from corpusmill.llm.packing import op3_packing
from corpusmill.llm.pii import op6_pii
from corpusmill.llm.quality import op1_quality
from corpusmill.llm.secrets import op7_secrets


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_quality": op1_quality, "op2_ann": op2_ann, "op3_packing": op3_packing, "op4_line_dedup": op4_line_dedup, "op5_near_dedup": op5_near_dedup, "op6_pii": op6_pii, "op7_secrets": op7_secrets, "op8_exact_dedup": op8_exact_dedup, "op9_licenses": op9_licenses, "op10_mixing": op10_mixing}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": OP4_SQL, "op5_near_dedup": OP5_SQL, "op8_exact_dedup": OP8_SQL, "op10_mixing": OP10_SQL}
