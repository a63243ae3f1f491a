"""The queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from weir.llm.op1_substrings import op1_substrings
from weir.llm.op2_licenses import op2_licenses
from weir.llm.op3_passages import op3_passages
from weir.llm.op4_jaccard import op4_jaccard
from weir.llm.op5_quality import op5_quality
from weir.llm.op6_token_files import op6_token_files
from weir.llm.op7_mixing import op7_mixing
from weir.llm.op8_packing import op8_packing
from weir.llm.op9_embeddings import op9_embeddings
from weir.llm.op10_lines import op10_lines
from weir.llm.op11_manifest import op11_manifest
from weir.llm.op12_search import op12_search
from weir.llm.op13_decontaminate import op13_decontaminate
from weir.llm.oracle import ORACLE

QUERIES = {
    f.__name__: f
    for f in (
        op1_substrings,
        op2_licenses,
        op3_passages,
        op4_jaccard,
        op5_quality,
        op6_token_files,
        op7_mixing,
        op8_packing,
        op9_embeddings,
        op10_lines,
        op11_manifest,
        op12_search,
        op13_decontaminate,
    )
}

__all__ = ["ORACLE", "QUERIES"]
