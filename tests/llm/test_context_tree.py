"""Context-tree scores next to a plain recursive version; held-out gain; proper probabilities."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reviewloom.llm import context_tree as C
from reviewloom.llm.context_tree import DEPTH, END, START, log_gamma, scores

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return TOKEN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def canonical(text):
    return [START] * DEPTH + list(" ".join(tokens(text)).encode()) + [END]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Plain:
    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        self.weights = {}
        for text in texts:
            b = canonical(text)
            for t in range(DEPTH, len(b)):
                for i in range(8):
                    decision = (1 << i) | (b[t] >> (8 - i))
                    for d in range(DEPTH + 1):
                        context = tuple(b[t - d : t][::-1])
                        self.counts[context, decision][b[t] >> (7 - i) & 1] += 1
                        if d:
                            self.children[context[:-1], decision].add(context)

    def estimate(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.weights:
            own = self.estimate(node)
            self.weights[node] = own if len(node[0]) == DEPTH else np.logaddexp(own, self.below(node)) - math.log(2)
        return self.weights[node]

    def below(self, node):
        return sum(self.weighted((c, node[1])) for c in self.children[node])

    def chance(self, context, decision, bit, d=0):
        node = context[:d], decision
        counts = self.counts.get(node)
        if counts is None:
            return None
        own = (counts[bit] + 0.5) / (sum(counts) + 1)
        deeper = self.chance(context, decision, bit, d + 1) if d < DEPTH else None
        if deeper is None:
            return own
        share = 1 / (1 + math.exp(min(700, self.below(node) - self.estimate(node))))
        return share * own + (1 - share) * deeper

    def byte(self, context, byte):
        out = 1.0
        for i in range(8):
            p = self.chance(context, (1 << i) | (byte >> (8 - i)), byte >> (7 - i) & 1)
            out *= 0.5 if p is None else p
        return out

    def score(self, text):
        b = canonical(text)
        return sum(math.log10(self.byte(tuple(b[t - DEPTH : t][::-1]), b[t])) for t in range(DEPTH, len(b)))


def expected(docs):
    training = [t for d, t in docs if not held(d)]
    model = Plain(training)
    counts = Counter(x for t in training for x in [*tokens(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in docs:
        parts = [*tokens(t), None]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in parts)
        out.append((str(d), held(d), len(parts), sum(counts[x] > 0 for x in parts), n, base, model.score(t)))
    return sorted(out)


def run(df, **kw):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scores(df, **kw).collect())


def same(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])


DOCS = [(i, " ".join(f"{a}{b}" for a in ("the", "Ün", "of")[: 1 + i % 3] for b in ("tion", "er", " x\t\n", "!")[: 1 + i % 4])) for i in range(24)]
ODD = [(100, None), (101, ""), (102, " \n\t"), (103, "\x00é中 A"), (None, "null id"), (5, DOCS[5][1]), (5, DOCS[5][1])]


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 100, 12345.5, 1e9])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


@pytest.mark.parametrize("batch_bytes", [50, 10**9])
def test_scores_against_a_plain_version(rows, batch_bytes):
    df = rows("doc_id long, text string, batch int, score string, training int", *[(*d, 1, "x", 2) for d in DOCS + ODD])
    same(run(df, batch_bytes=batch_bytes, buckets=3), expected(DOCS + ODD))


def test_probabilities_of_all_bytes_sum_to_one():
    keys, counts = C._distinct(__import__("pyarrow").array(["abracadabra abra", "abc cab"]), np.array([True, True]))[C.GRAMS]
    contexts = np.unique(keys >> np.uint64(8))[:40]
    asked = np.unique(np.concatenate([keys, (contexts[:, None] << np.uint64(8) | np.arange(256, dtype=np.uint64)).ravel()]))
    full = np.zeros(len(asked), np.int64)
    full[np.searchsorted(asked, keys)] = counts
    trees = C.Subtrees(asked, full)
    top = C.Top(*(np.concatenate(x) for x in zip(*trees.roots())))
    p = 10.0 ** trees.log_probabilities(top)
    for c in contexts:
        assert p[asked >> np.uint64(8) == c].sum() == pytest.approx(1)


def test_nothing_to_learn_and_no_rows(rows):
    ids = [i for i in range(100) if held(i)][:2]
    df = rows("doc_id long, text string", *[(i, "ab c") for i in ids])
    for r in scores(df).collect():
        assert r.train_tokens == 0 and r.base_score == 0 and r.n_bytes == 5 and r.bits_per_byte == pytest.approx(8)
    assert scores(df.limit(0)).count() == 0


def test_a_very_long_text(rows):
    df = rows("doc_id long, text string", (4, "lorem ipsum " * 200_000), (2, "x"))
    got = {r.doc_id: r for r in scores(df).collect()}
    assert got[4].n_tokens == 400_001 and got[4].bits_per_byte < 0.01


def test_given_documents(spark):
    from reviewloom.llm.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = QUERIES["op5_context_tree_scores"](spark, folder).collect()
    training = Counter(x for d, t in texts.items() if not held(d) for x in [*tokens(t), None])
    n, v = sum(training.values()), len(training)
    assert len(out) == len(texts)
    for r in out:
        parts = [*tokens(texts[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(parts), sum(training[x] > 0 for x in parts), n)
        assert r.base_score == pytest.approx(sum(math.log10((training[x] + 1) / (n + v + 1)) for x in parts))
    fold = [r for r in out if r.held_out]
    # little text to learn from: still far below the eight bits of a byte
    assert sum(r.bits_per_byte * r.n_bytes for r in fold) / sum(r.n_bytes for r in fold) < 2.4


def test_held_out_score_comes_near_the_entropy_of_its_source(rows):
    draw = random.Random(2)
    parts = ["ti", "on", "er", "the", "sha", "in", "ou", "ly", "re", "nd", "bel", "ka"]
    docs, entropy = [], {}
    for i in range(400):
        sizes = [draw.randint(2, 5) for _ in range(60)]
        docs.append((i, " ".join("".join(draw.choices(parts, k=k)) for k in sizes)))
        entropy[i] = -sum(math.log10(4) + k * math.log10(len(parts)) for k in sizes)
    fold = [r for r in scores(rows("doc_id long, text string", *docs)).collect() if r.held_out]
    assert fold
    assert 1.08 * sum(entropy[r.doc_id] for r in fold) < sum(r.score for r in fold) < sum(entropy[r.doc_id] for r in fold)
