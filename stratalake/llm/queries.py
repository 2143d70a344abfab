"""The queries of this folder, each with the same query in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm.chat_format import OP4_SQL, op4_chat_format
from stratalake.llm.collocations import OP11_SQL, op11_collocations
from stratalake.llm.decontaminate import op7_decontaminate
from stratalake.llm.hash_ring import op1_hash_ring
from stratalake.llm.language_id import op3_language_id
from stratalake.llm.license_scan import OP2_SQL, op2_license_scan
from stratalake.llm.merkle import OP5_SQL, op5_merkle
from stratalake.llm.packing import op8_packing
from stratalake.llm.pii import op9_pii
from stratalake.llm.run_length import OP12_SQL, op12_run_length
from stratalake.llm.simhash_golay import op10_simhash
from stratalake.llm.variants import OP13_SQL, op13_variants
from stratalake.llm.warc import OP6_SQL, op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_hash_ring,
        op2_license_scan,
        op3_language_id,
        op4_chat_format,
        op5_merkle,
        op6_warc,
        op7_decontaminate,
        op8_packing,
        op9_pii,
        op10_simhash,
        op11_collocations,
        op12_run_length,
        op13_variants,
    )
}
SQL = {
    name: sql.strip()
    for name, sql in {
        "op2_license_scan": OP2_SQL,
        "op4_chat_format": OP4_SQL,
        "op5_merkle": OP5_SQL,
        "op6_warc": OP6_SQL,
        "op11_collocations": OP11_SQL,
        "op12_run_length": OP12_SQL,
        "op13_variants": OP13_SQL,
    }.items()
}
