import hashlib

import numpy as np

import corpus_pipeline
from kiln.llm.bpe import BpeCodec, tokenizer_path
from kiln.llm.langid import Profiles, fit_prototypes
from kiln.llm.common import id_bucket
from kiln.llm.toxicity import ToxicityScorer, toxicity_model
from kiln.sources.tables import table
from tests.llm.test_llm_neardup import brute
from tests.llm.test_llm_text import best_window

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_python(spark):
    docs = table(spark, SF, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    scorer = ToxicityScorer(toxicity_model(spark, docs, SF))
    rows = [r for r, s in zip(rows, scorer.scores([t for _, t in rows])) if s < 0.7]
    left = docs.where(docs.doc_id.isin([d for d, _ in rows]))
    langs, _ = Profiles(*fit_prototypes(left.where(id_bucket("doc_id", 4) != 2))).predict([t for _, t in rows])
    rows = [r for r, lang in zip(rows, langs) if lang != "und"]
    comp, _ = brute(rows, 5, 80)
    rows = [r for r, c in zip(rows, comp) if r[0] == c]
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    rows = [(d, t) for d, t in rows if not any(best_window(t, i) >= 0.8 for i in items if i[:12].split()[0].lower() in t.lower())]
    codec = BpeCodec(tokenizer_path())
    want = {(d, len(np.frombuffer(codec.encode(t), "<u4")), hashlib.sha256(codec.encode(t)).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest()) for d, t in rows}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_stages_keep_columns_and_take_empty_and_odd_tables(spark):
    odd = spark.createDataFrame([(1, None, None, None, None, 5), (2, "", "en", "s", 0, 5), (None, "Some text here.", "en", "s", 3, 5),
                                 (3, "Some text here.", "en", "s", 3, 5), (3, "Some text here.", "en", "s", 3, 5)],
                                "doc_id long, text string, lang string, source string, n_chars long, score int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.schema == odd.schema, name
        assert stage(spark, odd.where("false"), SF).count() == 0, name
        ids = sorted(r["doc_id"] or 0 for r in out.collect())
        assert ids == ([0, 3, 3] if name == "language" else [0, 1, 2, 3, 3]), name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).count() == 5
