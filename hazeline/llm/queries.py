"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import licenses
from .jpeg import op10_media
from .licenses import op3_licenses
from .mixing import op2_mixing
from .mtree import OP5_SQL, op5_topk
from .packing import op8_packing
from .quality import op9_quality
from .secrets import op7_secrets
from .simhash import op1_simhash
from .suffix import op4_suffix
from .suffixtree import op6_suffixtree


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_mixing": op2_mixing,
        "op3_licenses": op3_licenses,
        "op4_suffix": op4_suffix,
        "op5_topk": op5_topk,
        "op6_suffixtree": op6_suffixtree,
        "op7_secrets": op7_secrets,
        "op8_packing": op8_packing,
        "op9_quality": op9_quality,
        "op10_media": op10_media,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_licenses": licenses.sql(), "op5_topk": OP5_SQL}
