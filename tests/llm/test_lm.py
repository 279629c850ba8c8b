import math
import zlib
from collections import Counter, defaultdict

import pytest
from corpus import documents, table, words

from evenkeel.llm import lm


def brute(train):
    """Probabilities of the model that plain counting gives."""
    c, pairs = Counter(), Counter()
    for w in train:
        c.update(w)
        pairs.update(zip(["<s>", *w[:-1]], w))
    different = Counter(w for _, w in pairs)
    follow = defaultdict(lambda: [0, 0, 0])
    for (v, _), n in pairs.items():
        follow[v][min(n, 3) - 1] += 1
    of = lambda counts: lm.discounts(*(sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)))
    high, low = of(pairs), of(different)
    left = sum(low[min(x, 3)] for x in different.values()) / len(pairs)

    def p(v, w):
        lower = max(different[w] - low[min(different[w], 3)], 0) / len(pairs) + left / (len(c) + 1)
        total = len(train) if v == "<s>" else c[v]
        if not total:
            return lower
        f = follow[v]
        return max(pairs[v, w] - high[min(pairs[v, w], 3)], 0) / total + sum(high[k + 1] * f[k] for k in range(3)) / total * lower

    return c, p


@pytest.mark.parametrize("shard_bytes, most", [(1 << 24, 16), (1 << 10, 16), (1 << 8, 3)])
def test_scores_are_those_of_plain_counting(spark, monkeypatch, shard_bytes, most):
    monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(lm, "PAIR_BITS", most)
    monkeypatch.setattr(lm, "WORD_BITS", most - 2)
    monkeypatch.setattr(lm, "BUFFER", 500)
    rows = documents()
    train = [words(t) + ["</s>"] for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    c, p = brute(train)
    df = table(spark, rows)
    model = lm.train(df.where("crc32(cast(doc_id as string)) % 5 <> 1"))
    assert (model.tokens, model.vocabulary) == (sum(c.values()), len(c))
    got = {r["doc_id"]: r for r in lm.score(df, model).collect()}
    for i, t in rows:
        w = words(t) + ["</s>"]
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(w), sum(x in c for x in w))
        assert got[i]["score"] == pytest.approx(sum(math.log10(p(v, x)) for v, x in zip(["<s>", *w[:-1]], w)), rel=1e-9)
        base = sum(math.log10((c[x] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1))) for x in w)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9)
    for v in ("<s>", train[0][0]):
        assert sum(p(v, x) for x in c) + p(v, "never seen") == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    df = table(spark, documents(6))
    model = lm.train(df.limit(0))
    assert all(math.isfinite(r["score"]) for r in lm.score(df, model).collect())
    assert lm.score(df.limit(0), lm.train(df)).isEmpty()
