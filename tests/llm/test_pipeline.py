"""The pipeline against a brute-force version of its stages."""

import zlib

import corpus_pipeline
from rows import SMALL
from subledger.llm import language, mixing
from test_leaks import brute
from test_simhash import plain_components, plain_fingerprint


def test_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources",
                                                      "shard"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, columns = [docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "shard":
            assert out.columns == columns and out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    start, spoken, single, clean, mixed, shards = kept

    model = language.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    want = [r for r in start if model.predict(r.text)[0] != "und"]
    assert sorted(spoken) == sorted(want) and len(spoken) == len([r for r in start if language.known(r.text)])

    ids = sorted(r.doc_id for r in spoken)
    texts = {r.doc_id: r.text for r in spoken}
    component = plain_components(ids, [plain_fingerprint(texts[i]) for i in ids], 4)
    assert sorted(r.doc_id for r in single) == sorted(i for i, c in zip(ids, component) if i == c)
    assert all(texts[r.doc_id] == r.text for r in single)

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute([(r.doc_id, r.text) for r in single], bench)}
    assert sorted(clean) == sorted(r for r in single if r.doc_id not in leaked) and leaked

    words = lambda r: len(r.text.encode().split())
    names = sorted({r.source for r in clean})
    target = mixing.water_fill([sum(words(r) for r in clean if r.source == s) for s in names],
                               [mixing.WEIGHTS[i % 3] for i in range(len(names))], 1.5, 2.0)
    assert set(mixed) <= set(clean)
    for s, t in zip(names, target):
        mine = [r for r in mixed if r.source == s]
        assert abs(sum(map(words, mine)) - t) <= max(words(r) for r in clean if r.source == s)
    assert max(mixed.count(r) for r in mixed) <= 2

    assert sorted((r.doc_id, r.size, r.text_crc32) for r in shards) == sorted(
        (r.doc_id, len(r.text.encode()) + 8, zlib.crc32(r.text.encode())) for r in mixed)
    counts = [sum(r.shard == s for r in shards) for s in range(24)]
    assert max(counts) - min(counts) <= 1


def test_run_and_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
