import corpus_pipeline
from conftest import SF

from setforge.llm.common import stage, table
from setforge.llm.queries import ORACLES, QUERIES


def test_stages_by_themselves(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "mixing", "packing"]
    seen = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, SF))
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    rules, lines, joined, mixed = seen
    assert set(mixed) <= set(joined) <= set(lines) <= set(rules) < set(before)
    assert all(before[d] == t for d, t in rules.items())
    for d, text in lines.items():  # only whole lines go
        rest = iter(rules[d].split("\n"))
        assert all(any(x == y for y in rest) for x in text.split("\n"))
    counts = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    starts = [p.doc_id for p in pieces if p.start == 0]
    assert {d: starts.count(d) for d in set(starts)} == counts


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in QUERIES}
    assert set(ORACLES) <= set(QUERIES)


def test_unused_memory_goes_back(monkeypatch):
    """After each batch and at a task's end, when no batch is held any more."""
    import pyarrow as pa

    from setforge.llm import common

    seen = []

    class Pool:
        def release_unused(self):
            seen.append("released")

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = [pa.record_batch([pa.array([i])], names=["x"]) for i in range(3)]

    def compute(rows):
        for batch in rows:
            seen.append(batch.column("x")[0].as_py())
            yield batch
        seen.append("end")

    assert list(common.tidy(compute)(iter(batches))) == batches
    assert seen == [0, "released", 1, "released", 2, "released", "end", "released"]
