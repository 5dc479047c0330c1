"""Long texts, other patterns, odd hosts, dense tiles, rows without ids: results and growth."""
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltaic.llm import bag_minhash, byte_bpe, common, toxicity, url_rules
from voltaic.llm.components import spanning_links

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_exceptions_against_every_pair():
    rng = random.Random(1)
    model = toxicity.Model({" bad ": 2.0, " ba": 1.0, " worse thing ": 3.0, " x": 0.5}, ("bad apple", "a bad x", "x x", "no worse thing is"))
    matcher = toxicity.Matcher(model)
    for _ in range(300):
        own = rng.choices(["bad", "apple", "a", "x", "no", "worse", "thing", "is", "bath"], k=rng.randint(0, 25))
        line = " " + " ".join(own) + " "
        spared = [(i, i + len(p) + 2) for p in model.exceptions for i in range(len(line)) if line.startswith(f" {p} ", i)]
        want = sorted((i, e, w) for e, w in model.entries.items() for i in range(len(line)) if line.startswith(e, i)
                      and not any(a <= i and i + len(e) <= b for a, b in spared))
        assert sorted(matcher.hits(own)) == (want if own else [])


def test_a_long_text_of_hits_and_exceptions_takes_its_length():
    model = toxicity.Model({" bad ": 2.0, " ba": 1.0}, ("bad apple",))
    matcher = toxicity.Matcher(model)
    took = []
    for n in (20_000, 160_000):
        own = ["bad", "apple", "bad", "egg"] * (n // 4)
        start = time.process_time()
        assert len(matcher.hits(own)) == n // 2
        took.append(time.process_time() - start)
    assert took[1] < 40 * max(took[0], 0.01)  # eight times the words; the square would be 64 times


def test_phrases_around_a_match():
    line = " one two three "
    assert toxicity._neighbours(line, 0) == ["one two"]
    assert toxicity._neighbours(line, 4) == ["one two", "two three"]
    assert toxicity._neighbours(line, 8) == ["two three"]
    assert toxicity._neighbours(" one ", 0) == []


@pytest.mark.parametrize("pattern", [
    public_tokenizers.PATTERN,
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}++|\p{N}{1,3}+| ?[^\s\p{L}\p{N}]++[\r\n]*+|\s++$|\s*[\r\n]|\s+(?!\S)|\s+""",
    r"\p{L}+|\s+",
    r"(\w)+| |(?:x|[^x])",
])
def test_any_pattern_equals_the_library(pattern):
    import tiktoken

    content = byte_bpe.read_ranks(RANKS)
    ranks = byte_bpe.parse_ranks(content)
    codec = byte_bpe.Codec(content, pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    parts = ["x!\n\ny", " ", "\n", "\r\n", "abc", "It's", "1234", "é", "日本", "!!", "\t", "😀", "  ", "word "]
    texts = ["x!\n\ny", "", *["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(300)]]
    want = [library.encode_ordinary(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == want


def test_hosts_are_compared_as_written(spark):
    rules = [("block", "x", "/"), ("allow", "org.x", "/"), ("block", "b.a.com", ""), ("allow", "com", "")]
    urls = ["http://x\x01org/", "http://x.org/", "http://org.x/", "http://a.org.x/y", "http://a\x01b.com/", "http://b.a.com/", "http://a.com",
            None, "nothing", "http://com/" + "p" * 300_000]
    rows = [(None if i % 3 == 0 else 1, u) for i, u in enumerate(urls * 2)]
    table = spark.createDataFrame(rows, "page_id long, url string").withColumn("key", F.lit("k")).withColumn("rule", F.lit("r"))
    got = {}
    for r in url_rules.judge(table, rules, default="none").collect():
        got.setdefault((r["host"], r["path"][:3]), set()).add((r["rule"], r["verdict"]))
    assert got == {
        ("x\x01org", "/"): {(None, "none")}, ("x.org", "/"): {(None, "none")}, ("org.x", "/"): {("org.x/", "allow")},
        ("a.org.x", "/y"): {("org.x/", "allow")}, ("a\x01b.com", "/"): {("com", "allow")}, ("b.a.com", "/"): {("b.a.com", "block")},
        ("a.com", ""): {("com", "allow")}, ("", ""): {(None, "none")}, ("com", "/pp"): {("com", "allow")},
    }
    assert url_rules.judge(table, rules).count() == len(rows)
    plan = url_rules.judge(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(key" in plan and "xxhash64(path" in plan


def test_spanning_links_join_what_all_links_join():
    rng = np.random.default_rng(3)
    for nodes, links in ((1, 0), (30, 20), (30, 200), (300, 280)):
        a, b = rng.integers(0, nodes, (2, links)) * 7
        got = spanning_links(a, b)
        assert len(got) < max(1, len(set(a) | set(b)))

        def classes(pairs):
            label = {}
            for x, y in pairs:
                group = label.get(x, {x}) | label.get(y, {y})
                for z in group:
                    label[z] = group
            return {frozenset(g) for g in label.values() if len(g) > 1}

        assert classes(got.tolist()) == classes(zip(a.tolist(), b.tolist(), strict=True))


def test_a_dense_pair_of_tiles_gives_a_forest():
    """All of 512 texts linked with all of another 512, each a part of its own: under 1,024 links."""
    own = bag_minhash.features(np.arange(1, 60, dtype=np.uint64)).tobytes()
    sides = [[list(range(k, k + 512)), list(range(k, k + 512)), [own] * 512] for k in (0, 512)]
    types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
    columns = [pa.array([c], t) for side in sides for c, t in zip(side, types, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=list("abcdef"))
    out = list(bag_minhash._compare_tiles(0.8, iter([batch])))
    assert sum(b.num_rows for b in out) == 1023
    assert {x for b in out for x in b.column(0).to_pylist()} == set(range(1, 1024))


def test_rows_without_ids_are_classed_by_their_texts(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["red", "green", "blue", "sky", "sea", "sun"]) for _ in range(60)) for _ in range(12)]
    rows = [(None, t) for t in texts for _ in range(25)] + [(None, t + " more") for t in texts] + [(None, None), (None, None), (None, "!")]
    rows += [(7, texts[0]), (7, "another text of seven words"), (7, "another text of seven words")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__key", F.lit(1)).withColumn("__row", F.lit(2))
    found = bag_minhash.near_duplicates(table)
    assert found.count() == len(rows)
    with_seven = [r for r in found.collect() if r["class_id"] == 7]
    assert len(with_seven) == 25 + 1 + 3
    kept = bag_minhash.keep_one(table)
    assert kept.columns == table.columns
    left = sorted(str(r["text"]) for r in kept.collect())
    assert left.count("None") == 2 and left.count("!") == 1 and len(left) == 12 + 3 + 1
    assert ("another text of seven words" in left) and bag_minhash.keep_one(table.limit(0)).count() == 0


def test_workers_keep_one_operators_state_at_a_time():
    made = []
    get = lambda owner, key: common.worker_state(owner, key, lambda: made.append((owner, key)) or len(made))
    assert [get("a", 1), get("a", 1), get("a", 2), get("a", 2)] == [1, 1, 2, 2]
    common.worker_state("a", None)
    assert get("a", 2) == 2
    common.worker_state("b", None)
    assert get("a", 2) == 3 and get("b", 2) == 4 and get("a", 2) == 5
    common._KEPT.clear()
