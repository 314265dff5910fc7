import zlib

import numpy as np
import pytest

from setforge.llm.toxicity import bags, core, norms, project, toxicity, train, words_of


def kernel(a, b, decay=0.7, span=5):
    """Weights of common three-letter subsequences, letter by letter."""

    def bag(word):
        word, out = f"\x02{word}\x03", {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + span)):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0) + decay ** (k - i + 1)
        return out

    x, y = bag(a), bag(b)
    inner = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return inner(x, y) / np.sqrt(inner(x, x) * inner(y, y))


def test_kernel_against_plain_subsequences():
    words = ["idiot", "idxiot", "i.d.i.o.t", "clown", "straße", "aa"]
    for a in words:
        owner, feature, weight = bags([a])
        vector = np.zeros(1 << 17)
        vector[feature] = weight / norms(owner, weight, 1)[0]
        assert np.allclose(project(words, vector), [kernel(a, b) for b in words], atol=2e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 6000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    hit = [r.predicted for r in rows if r.toxic == 1]
    false = [r.predicted for r in rows if r.toxic == 0]
    assert len(hit) > 30 and np.mean(hit) > 0.8 and np.mean(false) < 0.015, (np.mean(hit), np.mean(false))


@pytest.mark.parametrize("seed", range(10))
def test_changed_spellings(seed):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("tanrelos"), rng.integers(3, 9)))
    insults = ["dumbhead", "gimpfool", "jerkwad"]
    texts = [" ".join(word() for _ in range(40)) for _ in range(400)]
    toxic = [int(i % 4 == 0) for i in range(400)]
    texts = [t + f" {insults[i % 3]} " + word() if y else t for i, (t, y) in enumerate(zip(texts, toxic, strict=True))]
    model = train(texts, toxic)
    changed = ["dumbhead", "dumbxhead", "dum-bhead", "gimpfools", "gimqpfool", "jerk-wad", "jerkxwad", "j.erkwad"]
    bad = model.probability(model.raw(changed))
    good = model.probability(model.raw([word() for _ in range(300)]))
    assert bad.min() > 0.7 and good.max() < 0.5, dict(zip(changed, bad, strict=True))


def test_words_and_missing_labels():
    texts = ["one two", "three"]
    assert train(texts, [0] * 2) is None and train([], []) is None
    assert words_of("An I d i o t here") == ["an", "i", "d", "i", "o", "t", "here", "idiot"]
    assert core("«Fool!»") == "Fool"


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (6, None), (None, 0)], "doc_id long, toxic int")
    rows = toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.0} and {r.predicted for r in rows} == {0}
    assert toxicity(nothing, labels).count() == 0
