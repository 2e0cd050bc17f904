"""Queries of this subpackage on the test tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobsignals.llm.boilerplate import OP2_SQL, op2_site_boilerplate
from jobsignals.llm.decontaminate import op1_pigeonhole_decontamination
from jobsignals.llm.gridcodes import OP11_SQL, op11_grid_codes
from jobsignals.llm.mixing import op6_pfair_mix
from jobsignals.llm.nearcopies import op5_grouped_prefix_join
from jobsignals.llm.oracles import NEAR_COPIES
from jobsignals.llm.permutations import op3_permutation_index
from jobsignals.llm.quality import op8_quality
from jobsignals.llm.repeats import op10_suffix_dedup
from jobsignals.llm.segmentbpe import op12_segment_tree_bpe
from jobsignals.llm.shards import OP7_SQL, op7_interleaved_shards
from jobsignals.llm.stripes import OP13_SQL, op13_stripes_phrases
from jobsignals.llm.toxicity import op9_toxicity
from jobsignals.llm.warc import op4_warc_roundtrip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pigeonhole_decontamination": op1_pigeonhole_decontamination,
    "op2_site_boilerplate": op2_site_boilerplate,
    "op3_permutation_index": op3_permutation_index,
    "op4_warc_roundtrip": op4_warc_roundtrip,
    "op5_grouped_prefix_join": op5_grouped_prefix_join,
    "op6_pfair_mix": op6_pfair_mix,
    "op7_interleaved_shards": op7_interleaved_shards,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_grid_codes": op11_grid_codes,
    "op12_segment_tree_bpe": op12_segment_tree_bpe,
    "op13_stripes_phrases": op13_stripes_phrases,
}

ORACLES: dict[str, str] = {
    "op2_site_boilerplate": OP2_SQL,
    "op5_grouped_prefix_join": NEAR_COPIES,
    "op7_interleaved_shards": OP7_SQL,
    "op11_grid_codes": OP11_SQL,
    "op13_stripes_phrases": OP13_SQL,
}
