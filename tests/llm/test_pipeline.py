import re

import corpus_pipeline
from test_dedup import LOWER, brute_cut, brute_links, brute_windows, split


def test_stages_against_brute_force(spark, tmp_path, words):
    base, shared, end = words(150), words(70), words(90)
    rows = [(i, words(60 + i)) for i in range(12)]
    rows += [(20, base), (21, base.upper()), (22, base + " tail"), (23, words(20) + " " + shared + " " + words(40)), (24, shared + " " + end), (25, ""), (26, None)]
    toxic = [(100 + i, words(30) + " idiotish moronic scumlike " + words(10)) for i in range(40)]
    clean = [(200 + i, words(40)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows + toxic + clean], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i, _ in toxic + clean], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    out = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        kept.append(out)
    assert all(k.columns == docs.columns for k in kept[:-1])

    after = [{r.doc_id: r.text for r in k.select("doc_id", "text").collect()} for k in kept[:-1]]
    assert {i for i, _ in rows + clean} == set(after[0])
    texts = {i: (t or "").translate(LOWER) for i, t in after[0].items()}
    want = {max(i for i in texts if texts[i] == t) for t in texts.values()}
    assert set(after[1]) == want
    _, reach = brute_links([(i, t) for i, t in after[1].items()], 5, 80, 100)
    assert set(after[2]) == set(reach.values())
    lists = {i: split(t) for i, t in sorted(after[2].items())}
    first, _ = brute_windows(lists, corpus_pipeline.PASSAGE)
    left = {}
    for i, w in lists.items():
        gone = brute_cut(w, i, corpus_pipeline.PASSAGE, lambda x, at: first[x] != at)
        left[i] = [x for x, g in zip(w, gone, strict=True) if not g]
    assert {i: split(t) for i, t in after[3].items()} == {i: w for i, w in left.items() if w or not lists[i]}
    assert len(left[24]) == 90
    packed = {}
    for r in out.collect():
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in after[3].items()}


def test_run_equals_its_stages(spark, tmp_path, words):
    text = words(50)
    docs = [(i, words(50) if i < 6 else text, "en", "s", 1) for i in range(8)]
    toxic = [(100 + i, words(30) + " idiotish moronic scumlike", "en", "s", 1) for i in range(30)] + [(200 + i, words(40), "en", "s", 1) for i in range(30)]
    spark.createDataFrame(docs + toxic, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i < 200)) for i, *_ in toxic], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    stage = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, stage, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        stage = spark.read.parquet(str(tmp_path / f"stage{k}"))
    same = lambda df: sorted((r.doc_id, r.piece, r.length) for r in df.collect())
    assert same(out) == same(stage)
    assert {r.doc_id for r in out.collect()} == {*range(6), 7, *range(200, 230)}


def test_all_documents_stay_where_no_label_tells_toxic_ones(spark, tmp_path, words):
    docs = [(i, words(50), "en", "s", 1) for i in range(8)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(range(8))
