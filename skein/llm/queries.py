"""The registered queries of this package and the SQL that recomputes them where SQL can."""

from __future__ import annotations

from skein.llm.op1_divergence import op1_divergence
from skein.llm.op2_mix import op2_mix
from skein.llm.op3_extract import op3_extract
from skein.llm.op4_pack import op4_pack
from skein.llm.op5_ngram_join import op5_ngram_join
from skein.llm.op6_chat import OP6_SQL, op6_chat
from skein.llm.op7_url_filter import op7_url_filter
from skein.llm.op8_voronoi_knn import OP8_SQL, op8_voronoi_knn
from skein.llm.op9_pii import op9_pii
from skein.llm.op10_ctw import op10_ctw
from skein.llm.op11_treap_search import OP11_SQL, op11_treap_search
from skein.llm.op12_align import op12_align
from skein.llm.op13_toxicity import op13_toxicity

QUERIES = {
    "op1_divergence": op1_divergence,
    "op2_mix": op2_mix,
    "op3_extract": op3_extract,
    "op4_pack": op4_pack,
    "op5_ngram_join": op5_ngram_join,
    "op6_chat": op6_chat,
    "op7_url_filter": op7_url_filter,
    "op8_voronoi_knn": op8_voronoi_knn,
    "op9_pii": op9_pii,
    "op10_ctw": op10_ctw,
    "op11_treap_search": op11_treap_search,
    "op12_align": op12_align,
    "op13_toxicity": op13_toxicity,
}

ORACLES = {
    "op6_chat": OP6_SQL,
    "op8_voronoi_knn": OP8_SQL,
    "op11_treap_search": OP11_SQL,
}
