"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from . import oracle
from .decontamination import op10_decontamination
from .hard_negatives import op12_hard_negatives
from .jaccard_join import op1_jaccard_join
from .language_id import op9_language_id
from .line_dedup import op5_line_dedup
from .lm_scoring import op7_lm_scoring
from .packing import op2_packing
from .phrases import op13_collocations
from .quality import op8_quality_rules
from .secrets import op4_secret_scans
from .sharding import op11_sharding
from .url_filters import op3_url_filters
from .warc import op6_warc

Query = Callable[[SparkSession, str], DataFrame]

OPERATORS: list[Query] = [
    op1_jaccard_join,
    op2_packing,
    op3_url_filters,
    op4_secret_scans,
    op5_line_dedup,
    op6_warc,
    op7_lm_scoring,
    op8_quality_rules,
    op9_language_id,
    op10_decontamination,
    op11_sharding,
    op12_hard_negatives,
    op13_collocations,
]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {q.__name__: _shipped(q) for q in OPERATORS}
#: Queries without SQL are held against brute force in the tests.
ORACLE_SQL: dict[str, str] = {
    "op3_url_filters": oracle.URL_FILTERS,
    "op5_line_dedup": oracle.LINE_DEDUP,
    "op6_warc": oracle.WARC,
    "op10_decontamination": oracle.DECONTAMINATION,
    "op12_hard_negatives": oracle.HARD_NEGATIVES,
    "op13_collocations": oracle.COLLOCATIONS,
}
