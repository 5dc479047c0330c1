"""Every operator on nulls, empty and very long texts, repeats, ties, empty tables and clashing columns."""
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from voltaic.llm import arrow_ids, bag_minhash, byte_bpe, fm_index, langid, pca_dedup, token_counts, toxicity, url_rules, warc
from voltaic.llm.common import Scratch

BYTES = {"path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "der lange Text und noch ein Wort " * 20_000
SCHEMA = "doc_id long, text string, score string, n_tokens string, ids string, n_words string, class_id string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None), (2, ""), (3, "   "), (4, "!!! ..."), (5, "one two three"), (6, "one two three"), (None, "one two three"),
        (7, "a b c d e f g h i j k l m n o p"), (7, "a b c d e f g h i j k l m n o p"), (8, LONG), (9, None), (10, "日本語 のテスト"),
    ]
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_byte_bpe(docs, empty):
    out = byte_bpe.encode(docs, decode=True, **BYTES)
    assert out.count() == 12 and out.columns.count("ids") == 1 and "class_id" in out.columns
    got = by_id(out)
    assert got[1].n_tokens == 0 and bytes(got[1].decoded) == b"" and got[2].n_tokens == 0
    assert bytes(got[8].decoded).decode() == LONG and bytes(got[10].decoded).decode() == "日本語 のテスト"
    again = byte_bpe.decode(byte_bpe.encode(docs, **BYTES), path=BYTES["path"])
    assert bytes(by_id(again)[8].decoded).decode() == LONG
    assert byte_bpe.encode(empty, **BYTES).count() == 0


def test_token_counts(docs, empty):
    got = by_id(token_counts.count_tokens(docs, path=PIECES))
    assert got[1].n_words == got[3].n_tokens == 0 and got[8].n_words == 140_000
    assert token_counts.count_tokens(empty, path=PIECES).count() == 0


def test_language(docs, empty, spark):
    labelled = docs.withColumn("lang", F.when(F.col("doc_id") == 8, "de").when(F.col("doc_id") == 5, "en"))
    model = langid.fit(labelled)
    assert model.languages == ["de", "en"]
    got = by_id(langid.predict(docs, model))
    assert got[1].lang_pred == got[2].lang_pred == got[4].lang_pred == "und" and got[4].score == 0
    assert got[8].lang_pred == "de" and got[6].lang_pred == "en" and 0 < got[6].score <= 1
    none = langid.fit(empty.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_toxicity(spark, docs, empty):
    texts = [(i, f"plain words number {i} here") for i in range(200)]
    texts += [(1000 + i, f"you are a loweix{i % 5} thing and a tra5h heap {i % 7}") for i in range(30)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in texts] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(table, labels)
    assert any(e.strip().startswith("lowei") for e in model.entries)
    probe = spark.createDataFrame([(1, "what a lоwеix9 TRA5H"), (2, "a nice day"), (3, None)], "doc_id long, text string")
    got = by_id(toxicity.score(probe, model))
    assert got[1].predicted == 1 and got[2].predicted == got[3].predicted == 0
    assert toxicity.score(docs, model).count() == 12 and toxicity.score(empty, model).count() == 0
    assert toxicity.fit(table, labels.where("toxic = 7")).entries == {}
    spared = toxicity.Model({" trash ": 5.0}, ("trash can",), (-4.0, 2.0, 1.0))
    got = by_id(toxicity.score(spark.createDataFrame([(1, "the trash can"), (2, "such trash")], "doc_id long, text string"), spared))
    assert got[1].n_hits == 0 and got[2].n_hits == 1


def test_decontamination(spark, docs, empty):
    items = [(1, "d e f g h i j k l m"), (2, "One, TWO"), (3, None), (4, "..."), (2, "one two"), (None, "three"), (5, "x y")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 1):
        got = by_id(fm_index.find_spans(docs, bench, block_windows=block))
        assert (got[7].n_words, got[7].n_hit, got[7]["items"]) == (16, 10, ["1"])
        assert [tuple(s) for s in got[7].spans] == [(3, 13)]
        assert got[5].n_hit == 3 and got[5]["items"] == ["2", "null"] and got[1].n_words == 0
    assert fm_index.find_spans(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert fm_index.find_spans(empty, bench).count() == 0
    digest = by_id(fm_index.digest(fm_index.find_spans(docs, bench)))
    assert digest[7].contaminated and not digest[8].contaminated


def test_near_duplicates(spark, docs, empty):
    found = bag_minhash.near_duplicates(docs)
    assert found.count() == 12
    rows = [(r.id, r.class_id, r.kept) for r in found.collect()]
    assert rows.count((7, 7, True)) == 2 and (5, 5, True) in rows and (6, 5, False) in rows and (None, 5, False) in rows
    assert (1, 1, True) in rows and (4, 4, True) in rows
    kept = bag_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert bag_minhash.near_duplicates(empty).count() == 0


def test_warc(spark):
    pages = [(1, "http://a/b c", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "ä" * 300_000), (6, "u", "y"),
             (6, "u", "y"), (None, "u", "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("first", F.lit(1))
    got = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read(warc.write(table, Scratch(spark, "t"))).collect()]
    assert sorted(got, key=str) == sorted([
        ("1", "response", None, 1), ("2", "revisit", "1", 1), ("3", "response", None, 0), ("4", "revisit", "3", 0),
        ("5", "response", None, 600_000), ("6", "response", None, 1), ("6", "revisit", "6", 1), (None, "revisit", "1", 1),
    ], key=str)
    assert warc.read(warc.write(table.limit(0), Scratch(spark, "t"))).count() == 0
    assert warc.read(warc.write(table, Scratch(spark, "t"), least_bytes=2)).where("record_type = 'revisit'").count() == 0


def test_warc_damage(tmp_path):
    import io

    good = warc.record([("WARC-Type", "response"), ("WARC-Block-Digest", f"sha1:{warc.digest(b'abc')}")], b"abc")
    assert [b for _, b in warc.records(io.BytesIO(good * 3))] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-9])))
    bad = warc.record([("WARC-Type", "response"), ("WARC-Block-Digest", f"sha1:{warc.digest(b'abd')}")], b"abc")
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(bad)))


def test_token_ids(spark, docs, empty):
    import pyarrow as pa

    from voltaic.llm.files import reading

    manifest = arrow_ids.write(docs, Scratch(spark, "t"), path=WORDS, end_id=2, length=16, shards=3)
    got = arrow_ids.read(manifest).collect()
    assert len(got) == 12
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(order, order[1:]))
    assert [r.n_tokens for r in order if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    for file in manifest.collect():
        with reading(file.file) as source:
            table = pa.ipc.open_file(source).read_all()
        mask = [m for row in table["mask"].to_pylist() for m in row]
        assert sum(mask) == file.ids and mask == sorted(mask, reverse=True) and len(mask) % 16 == 0
    assert arrow_ids.read(arrow_ids.write(empty, Scratch(spark, "t"), path=WORDS, end_id=2)).count() == 0


def test_url_rules(spark):
    urls = ["http://EXAMPLE.org/es/1", "https://a.b.example.org/en/12?q", "x://org", "x://foo.org/", "nothing", None,
            "http://badexample.org/es/", "a://b://c/d", "http://com/fr/", "http://x.com/de/#a", "http:///p"]
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("block", "com", "/de/")]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(table, rules).collect()}
    assert got[0] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("a.b.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("org", "", None, "allow") and got[3] == ("foo.org", "/", "org/", "allow")
    assert got[4] == got[5] == ("", "", None, "allow") and got[6][2] == "org/"
    assert got[7] == ("b:", "//c/d", None, "allow") and got[8] == ("com", "/fr/", None, "allow")
    assert got[9] == ("x.com", "/de/", "com/de/", "block") and got[10] == ("", "/p", None, "allow")
    assert url_rules.judge(table.limit(0), rules).count() == 0 and url_rules.judge(table, []).count() == 11


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.05], 1), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [1.0, None], 1), (8, [float("nan"), 1.0], 1), (9, [1.0, 0.0], None), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [0.9, 0.3], 1), (None, [-1.0, 0.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit(1))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pca_dedup.near_duplicates(table).collect()), key=str)
    assert got == sorted([
        (1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (4, 4, 1, False), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
        (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (11, 0, 11, True), (12, 4, 1, False), (12, 4, 1, False),
        (13, 0, 13, True), (None, 0, None, True),
    ], key=str)
    assert pca_dedup.near_duplicates(table.limit(0)).count() == 0


def test_token_ids_equal_the_library(monkeypatch):
    """Random texts of accents, odd white space and special-token strings, with a cache that keeps being forgotten."""
    import random

    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    with open(WORDS, encoding="utf-8") as f:
        content = f.read()
    library = Tokenizer.from_str(content)
    library.encode_special_tokens = True
    rng = random.Random(3)
    parts = [*"abcABC.,'!?09éÉçŉſĳŁ÷ß", "é", "İ", "Σσς", "日本", "😀", " ", "\t", "\n", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>"]
    texts = [None, "", " ", ".", ",.", "é,", "x" * 5000] + ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    monkeypatch.setattr(arrow_ids, "CACHE_ENTRIES", 500)
    encoder = arrow_ids.Encoder(content)
    for i in range(0, len(texts), 200):
        own = texts[i : i + 200]
        ids, lengths = encoder.encode(pa.array([None, *own], pa.string()).slice(1))
        got = [g.tolist() for g in np.split(ids, np.cumsum(lengths)[:-1])]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in own]


def _ids(encoder, texts):
    import numpy as np
    import pyarrow as pa

    ids, lengths = encoder.encode(pa.array(texts, pa.string()))
    return [g.tolist() for g in np.split(ids, np.cumsum(lengths)[:-1])]


def test_added_tokens_equal_the_default_library(monkeypatch):
    """Random texts with whole, broken and joined special tokens against the library as it comes."""
    import random

    from tokenizers import Tokenizer

    with open(WORDS, encoding="utf-8") as f:
        content = f.read()
    library = Tokenizer.from_str(content)
    rng = random.Random(7)
    parts = [*"aB.,'9é|<>", "\u0301", "日", " ", "\t", "\x85", "\xa0", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", None, "a<|endoftext|>b", "x\xa0<|startoftext|>\x85y"]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(2000)]
    monkeypatch.setattr(arrow_ids, "CACHE_ENTRIES", 500)
    monkeypatch.setattr(arrow_ids, "_STATES", {})
    encoder = arrow_ids._encoder(content)
    for i in range(0, len(texts), 200):
        own = texts[i : i + 200]
        assert _ids(encoder, own) == [library.encode(t or "", add_special_tokens=False).ids for t in own]


def test_added_tokens_of_other_kinds(monkeypatch):
    """Tokens with white space, found after normalizing, taking the white space around or standing alone."""
    from tokenizers import AddedToken, Tokenizer

    texts = ["a [sep one] b", "x[SEP ONE]y", "a [cls] b", "a[cls]b", "a[CLS] b", "plain words", "", "a [sep\tone]"]
    for kind in ({"normalized": False}, {"normalized": True}, {"normalized": False, "lstrip": True, "rstrip": True},
                 {"normalized": False, "single_word": True}):
        library = Tokenizer.from_file(WORDS)
        library.add_tokens([AddedToken("[sep one]", **kind), AddedToken("[cls]", **kind)])
        monkeypatch.setattr(arrow_ids, "_STATES", {})
        got = _ids(arrow_ids._encoder(library.to_str()), texts)
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts], kind


def test_token_ids_with_special_tokens_in_the_text(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    texts = ["hello <|endoftext|> world", "one two", "<|startoftext|>a", None, "three"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(arrow_ids.read(arrow_ids.write(table, Scratch(spark, "t"), path=WORDS, end_id=2, length=4, shards=2)))
    start = 0
    for doc, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_range_keys_of_token_ids_hold_no_texts(spark, monkeypatch):
    """Spark collects a sample of the range keys to the driver."""
    docs = spark.createDataFrame([(2, "b a"), (1, "x"), (1, "y"), (None, "z"), (1, "x"), (1, None)], "doc_id long, text string")
    kind, seen = type(docs), []
    dealt = kind.repartitionByRange

    def spy(self, count, *keys):
        seen.append([f.dataType.simpleString() for f in self.select(*keys).schema.fields])
        return dealt(self, count, *keys)

    monkeypatch.setattr(kind, "repartitionByRange", spy)
    got = arrow_ids.read(arrow_ids.write(docs, Scratch(spark, "t"), path=WORDS, end_id=2, length=4, shards=3)).collect()
    assert seen == [["bigint", "bigint"]]
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, 1, 1, 1, 1, 2]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(order, order[1:]))
    crcs = [r.ids_crc32 for r in order[1:5]]
    assert len(set(crcs)) == 3 and sum(a == b for a, b in zip(crcs, crcs[1:])) == 1


def test_rows_of_an_id_file_by_number(tmp_path, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from voltaic.llm.files import writing

    monkeypatch.setattr(arrow_ids, "BATCH_ROWS", 8)
    rng = np.random.default_rng(6)
    name = f"file://{tmp_path}/x/rows.arrow"
    docs = [rng.integers(0, 60_000, n).astype(np.uint16) for n in [41, 1, 0, 300, *rng.integers(1, 70, 40)]]
    with writing(name) as out:
        writer = arrow_ids.ShardWriter(out, 4, pa.uint16())
        for i, ids in enumerate(docs):
            writer.add(i, ids)
        writer.close()
    flat = np.concatenate(docs)
    count = -(-len(flat) // 4)
    rows = arrow_ids.Rows(name)
    sizes = [rows.file.get_batch(k).num_rows for k in range(rows.file.num_record_batches)]
    assert set(sizes[:-1]) == {8} and 0 < sizes[-1] <= 8 and sum(sizes) == len(rows) == count
    padded = np.append(flat, np.zeros(count * 4 - len(flat), np.uint16))
    before = pa.total_allocated_bytes()
    for r in (0, 7, 8, count - 1, *range(count)):
        ids, mask = rows[r]
        assert ids.tolist() == padded[4 * r : 4 * r + 4].tolist() and not ids.flags.owndata
        assert mask.to_pylist() == [4 * r + k < len(flat) for k in range(4)]
    assert pa.total_allocated_bytes() == before
    for r in (-1, count):
        with pytest.raises(IndexError):
            rows[r]
    starts = [s for k in range(len(sizes)) for s in rows.file.get_batch(k).column(3).flatten().to_pylist()]
    assert starts == np.cumsum([0, *map(len, docs)])[:-1].tolist()
