"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from adfuse.llm import oracle
from adfuse.llm.chat import op6_chat_format
from adfuse.llm.collocations import op12_collocations
from adfuse.llm.decontaminate import op8_decontaminate
from adfuse.llm.license_scan import op2_license_scan
from adfuse.llm.near_dedup import op5_near_dedup
from adfuse.llm.packing import op3_pack
from adfuse.llm.quality_rules import op7_quality
from adfuse.llm.repair import op11_repair
from adfuse.llm.secret_scan import op1_secret_scan
from adfuse.llm.sharding import op10_byte_shards
from adfuse.llm.simhash import op4_simhash
from adfuse.llm.toxicity import op9_toxicity
from adfuse.llm.url_filter import op13_url_filter

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_license_scan": op2_license_scan,
    "op3_pack": op3_pack,
    "op4_simhash": op4_simhash,
    "op5_near_dedup": op5_near_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_toxicity": op9_toxicity,
    "op10_byte_shards": op10_byte_shards,
    "op11_repair": op11_repair,
    "op12_collocations": op12_collocations,
    "op13_url_filter": op13_url_filter,
}

ORACLE = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
