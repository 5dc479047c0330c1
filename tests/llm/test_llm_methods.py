"""The methods inside the operators: index, signatures, merges, components, tiles; and the pipeline."""
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from voltaic.llm import bag_minhash, byte_bpe, fm_index, pca_dedup
from voltaic.llm.common import Scratch, words
from voltaic.llm.components import connected_components


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=30), min_size=1, max_size=6), st.integers(1, 5))
def test_fm_index_finds_every_occurrence(stretches, size):
    index = fm_index.FMIndex([np.array(s) for s in stretches], 4)
    windows = np.array([[random.Random(i * 7 + k).randint(1, 4) for k in range(size)] for i in range(20)])
    low, high = index.search(windows, np.full(20, size))
    for window, a, b in zip(windows.tolist(), low, high, strict=True):
        got = sorted(index.locate(np.arange(a, b)).tolist())
        want = sorted(
            int(start) + k
            for s, start in zip(stretches, index.starts, strict=True)
            for k in range(len(s) - size + 1)
            if s[k : k + size] == window
        )
        assert got == want


def test_signatures_estimate_weighted_jaccard_without_bias():
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 2**63, 400).astype(np.uint64)
    for copies in (1, 3, 9):
        a = np.repeat(pool[:300], rng.integers(1, copies + 1, 300))
        b = np.repeat(pool[60:], rng.integers(1, copies + 1, 340))
        x, y = Counter(a.tolist()), Counter(b.tolist())
        true = sum((x & y).values()) / sum((x | y).values())
        first = bag_minhash.signatures([a, b], 4000)
        assert abs((first[0] == first[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / 4000)
    assert np.isfinite(bag_minhash.signatures([pool[:1]], 80)).all()
    assert np.isinf(bag_minhash.signatures([pool[:0]], 80)).all()


def test_tile_overlaps_equal_pairwise_overlaps():
    rng = np.random.default_rng(1)
    texts = [bag_minhash.features(rng.integers(0, 60, rng.integers(1, 90)).astype(np.uint64)) for _ in range(40)]
    got = bag_minhash.overlaps(texts[:20], texts[20:])
    for i, a in enumerate(texts[:20]):
        for j, b in enumerate(texts[20:]):
            common = len(np.intersect1d(a, b))
            assert got[i, j] == common / (len(a) + len(b) - common)


def test_links_between_members_that_miss_the_centre(spark):
    """A chain of texts, each close to the next only: one class, whatever the centres are."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(base)))
        base = base[8:] + [f"w{rng.randrange(10**6)}" for _ in range(8)]
    rows += [(100 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(50))) for i in range(20)]
    found = bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    classes = {r.id: r.class_id for r in found.collect()}
    assert all(classes[i] == 0 for i in range(60)) and all(classes[100 + i] == 100 + i for i in range(20))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcde ñ日'1.\n"), max_size=70), max_size=6))
def test_batch_merges_equal_single_merges(texts):
    codec = byte_bpe.codec(
        byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    )
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        single = [i for m in codec.pattern.findall(text) for i in byte_bpe.merge(m.encode(), codec.ranks, codec.longest)]
        assert np.frombuffer(ids, "<u4").tolist() == single
    assert [d.decode() for d in codec.decode(codec.encode(texts))] == texts


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1200)]
    label = {n: n for e in edges for n in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in connected_components(table, Scratch(spark, "t")).collect()}
    assert got == {n: c for n, c in label.items() if n != c}


def test_tiles_lose_no_pair():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(5, 24))
    rows = np.repeat(centre, 60, axis=0) + rng.normal(scale=0.12, size=(300, 24))
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    i, j = pca_dedup.links_between(unit, unit, 0.98, True, (4, 8))
    true = {(a, b) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.98, 1)))}
    assert true == {(a, b) for a, b in zip(i, j) if unit[a] @ unit[b] >= 0.98} and len(true) > 50


def test_pipeline_against_brute_force(spark):
    """Later stages on their own inputs, by plain Python; models are taken from the stages themselves."""
    import corpus_pipeline as cp
    import tiktoken

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = Scratch(spark, "t").store(stage(spark, docs, SF_SMALL), name)
        kept[name] = (before, {r.doc_id: r for r in docs.collect()})
        if name != "byte_bpe":
            assert docs.columns == cp.COLUMNS
            assert all(before[d].text == r.text for d, r in kept[name][1].items())
    before, after = kept["language_id"]
    assert all(r.doc_id in after for r in before.values() if len(r.text.split()) > 20)

    before, after = kept["near_dedup"]
    bags = {}
    for d, r in before.items():
        own = words(r.text)
        bags[d] = Counter(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4) if own else 0))
    label = {d: d for d in bags}
    ids = sorted(bags)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) / sum((bags[a] | bags[b]).values()) >= 0.8
    ]
    for _ in links:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert set(after) == {d for d in ids if label[d] == d}

    before, after = kept["decontamination"]
    windows = set()
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF_SMALL}/benchmark.parquet'").fetchall():
        own = words(text)
        windows.update(tuple(own[i : i + 10]) for i in range(max(1, len(own) - 9) if own else 0))
    sizes = {len(w) for w in windows}
    assert set(after) == {
        d for d, r in before.items()
        if not any(tuple(words(r.text)[i : i + n]) in windows for n in sizes for i in range(len(words(r.text)) - n + 1))
    }

    before, after = kept["byte_bpe"]
    ranks = byte_bpe.parse_ranks(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {d: r.n_tokens for d, r in after.items()} == {d: len(library.encode_ordinary(r.text)) for d, r in before.items()}
    assert cp.run(spark, SF_SMALL).count() == len(after)


def test_pipeline_rejects_by_score_and_language(spark):
    """What the first two stages keep, by plain Python over each stage's own input with its own model."""
    import math
    import zlib

    import corpus_pipeline as cp

    from voltaic.llm import langid, toxicity

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = [(-1, "123 ... 456"), (-2, ""), (-3, None), (-4, "12 !?")]
    odd = spark.createDataFrame([(i, t, "en", "x", 0) for i, t in odd], cp.COLUMNS)
    docs = docs.select(cp.COLUMNS).union(odd.select([odd[c].cast(docs.schema[c].dataType) for c in cp.COLUMNS]))
    rows = {r.doc_id: r for r in docs.collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())

    learn = [d for d in rows if zlib.crc32(str(d).encode()) % 3 != 1]
    table = spark.read.parquet(f"{folder}/labels.parquet")
    ids = spark.createDataFrame([(d,) for d in learn], "doc_id long")
    model = toxicity.fit(docs.join(ids, "doc_id"), table.join(ids, "doc_id"))
    spared = [" " + " ".join(toxicity.fold(p)) + " " for p in model.exceptions]

    def places(line, entry):
        return [i for i in range(len(line)) if line.startswith(entry, i)]

    def score(text):
        words = toxicity.fold(text)
        line = " " + " ".join(words) + " "
        free = [(i, i + len(p)) for p in spared for i in places(line, p)]
        best = {}
        for entry, weight in model.entries.items():
            for i in places(line, entry) if words else ():
                if not any(a <= i and i + len(entry) <= b for a, b in free):
                    best[i] = max(weight, best.get(i, 0.0))
        total = sum(best.values())
        a, b, c = model.curve
        return 1 / (1 + math.exp(-(a + b * math.log1p(total) + c * math.log1p(1000 * total / max(len(words), 1)))))

    after = {r.doc_id for r in cp.remove_toxic(spark, docs, folder).collect()}
    assert after == {d for d, r in rows.items() if score(r.text) < 0.7}
    planted = [d for d in rows if labels.get(d) == 1]
    clean = [d for d in rows if labels.get(d) == 0]
    assert len(planted) > 40 and sum(d not in after for d in planted) >= 0.75 * len(planted)
    assert sum(d in after for d in clean) >= 0.98 * len(clean)

    learn = [d for d in rows if zlib.crc32(str(d).encode()) % 4 != 2]
    model = langid.fit(docs.join(spark.createDataFrame([(d,) for d in learn], "doc_id long"), "doc_id"))

    def known(text):
        low = (text or "").lower()
        run = "".join(c if c.isalpha() else " " if i and low[i - 1].isalpha() else "" for i, c in enumerate(low))
        if not any(map(str.isalpha, run)):
            return False
        total, grams = model.log_prior.copy(), 0
        for order in model.orders:
            for i in range(len(run) - order + 1):
                h = order
                for c in run[i : i + order]:
                    h = (h ^ ord(c)) * 0x9E3779B1 % 2**32
                    h ^= h >> 15
                total += model.log_prob[:, (h * 0x85EBCA6B % 2**32) >> (32 - model.bits)]
                grams += 1
        scaled = (total - total.max()) * min(1, 100 / max(grams, 1))
        return 1 / np.exp(scaled).sum() >= 0.5

    # The plain loop is slow: every short text, and every eleventh of the long ones.
    tried = [d for k, d in enumerate(sorted(rows)) if len(rows[d].text or "") < 300 or k % 11 == 0]
    after = {r.doc_id for r in cp.keep_known_language(spark, docs, folder).collect()}
    assert {-1, -2, -3, -4}.isdisjoint(after)
    assert after & set(tried) == {d for d in tried if known(rows[d].text)}
