"""Queries of the corpus operators: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

import corpus_pipeline
from kiln.llm.bpe import op3_bpe
from kiln.llm.brown import op6_brown
from kiln.llm.decontaminate import op7_decontaminate
from kiln.llm.exactdup import OP13_SQL, op13_exactdup
from kiln.llm.html import op2_html
from kiln.llm.langid import op1_language
from kiln.llm.licenses import op10_license
from kiln.llm.neardup import op4_neardup
from kiln.llm.prefixtrie import OP11_SQL, op11_prefixtrie
from kiln.llm.topk import OP8_SQL, op8_topk
from kiln.llm.toxicity import op5_toxicity
from kiln.llm.vafile import OP12_SQL, op12_vafile
from kiln.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_language": (op1_language, None),
    "op10_license": (op10_license, None),
    "op11_prefixtrie": (op11_prefixtrie, OP11_SQL),
    "op12_vafile": (op12_vafile, OP12_SQL),
    "op13_exactdup": (op13_exactdup, OP13_SQL),
    "op2_html": (op2_html, None),
    "op3_bpe": (op3_bpe, None),
    "op4_neardup": (op4_neardup, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_brown": (op6_brown, None),
    "op7_decontaminate": (op7_decontaminate, None),
    "op8_topk": (op8_topk, OP8_SQL),
    "op9_warc": (op9_warc, OP9_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
