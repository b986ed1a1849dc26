import sentencepiece

import corpus_pipeline as P
from revlens.llm import quality as Q
from revlens.llm.piece_bpe import MODEL
from tests.llm.test_native_dedup import plain_lines
from tests.llm.test_near_dedup import plain_groups
from tests.llm.test_scan_decontaminate import plain_hits

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    score = {r.doc_id: r.score for r in Q.op9_quality(spark, SF).collect()}
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), "test-stage")
        after = {r.doc_id: r for r in docs.collect()}
        rows = [(i, r.text) for i, r in sorted(before.items())]
        if name != "pieces":
            assert docs.columns == columns
        if name == "quality":
            assert set(after) == {i for i in before if score[i] >= Q.THRESHOLD}
        elif name == "lines":
            assert {i: r.text for i, r in after.items()} == {i: t for i, t, _, _ in plain_lines(rows)}
            assert all(r.n_chars == (len(r.text) if r.text != before[i].text else before[i].n_chars) for i, r in after.items())
        elif name == "near_copies":
            assert set(after) == {i for i, _, _, kept in plain_groups(rows, 5) if kept}
        elif name == "benchmark":
            assert set(after) == {i for i, t in rows if not plain_hits(t, items)[1]}
        else:
            lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
            assert {i: (r.ids, r.decoded) for i, r in after.items()} == {i: (lib.encode(t), lib.decode(lib.encode(t))) for i, t in rows}
            assert len(after) > 50
        if name in ("quality", "near_copies", "benchmark"):
            assert all(after[i] == before[i] for i in after)
        before = after
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, docs.collect()))
