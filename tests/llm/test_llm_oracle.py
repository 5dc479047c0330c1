"""Numbered queries against DuckDB SQL, brute force or the library they follow, on whole small tables."""
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from oracle_check import canon, con_for

from voltaic.llm.queries import BYTE_VOCABULARY, ORACLE, PIECE_VOCABULARY, QUERIES, WORD_VOCABULARY


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    got = canon(QUERIES[name](spark, SF_SMALL).toPandas(), 6)
    assert got == canon(con_for(SF_SMALL).sql(ORACLE[name]).df(), 6)


def test_warc_digest_is_base32_sha1(spark):
    import base64

    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall())
    for row in QUERIES["op4_warc"](spark, SF_SMALL).collect():
        payload = (pages[row.page_id] or "").encode()
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_token_ids_match_the_library(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORD_VOCABULARY))
    got = {r.doc_id: r for r in QUERIES["op5_token_ids"](spark, SF_SMALL).collect()}
    assert len(got) == len(documents)
    start = 0
    for doc, text, _ in documents:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        row = got[doc]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_byte_bpe_matches_the_library(spark, documents):
    import tiktoken

    from voltaic.llm.byte_bpe import parse_ranks, read_ranks

    ranks = parse_ranks(read_ranks(public_tokenizers.path(BYTE_VOCABULARY)))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, SF_SMALL).collect()}
    for doc, text, _ in documents:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_token_counts_match_a_plain_search(spark, documents):
    import functools

    from voltaic.llm import token_counts as tc

    scores = tc.piece_scores(tc.read_pieces(public_tokenizers.path(PIECE_VOCABULARY)))
    longest, floor = max(map(len, scores)), min(scores.values()) - 10

    @functools.cache
    def best(word):
        top = [(0.0, 0)] + [(-1e18, 0)] * len(word)
        for stop in range(1, len(word) + 1):
            for start in range(max(0, stop - longest), stop):
                piece = word[start:stop]
                if piece in scores and top[start][0] + scores[piece] > top[stop][0]:
                    top[stop] = (top[start][0] + scores[piece], top[start][1] + 1)
            size = len(word[stop - 1].encode())
            if word[stop - 1] not in scores and top[stop - 1][0] + size * floor > top[stop][0]:
                top[stop] = (top[stop - 1][0] + size * floor, top[stop - 1][1] + size)
        return top[-1][1]

    got = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, SF_SMALL).collect()}
    for doc, text, _ in documents[:60]:
        words = (text or "").split()
        assert (got[doc].n_words, got[doc].n_tokens) == (len(words), sum(best("▁" + w) for w in words))


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 150
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95


def test_toxicity_held_out(spark):
    rows = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()
    truth = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    caught = [r for r in held if truth[r.doc_id] == 1]
    clean = [r for r in held if truth[r.doc_id] == 0]
    assert sum(r.predicted for r in caught) / len(caught) > 0.9
    assert sum(r.predicted for r in clean) / len(clean) < 0.02
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    scores = sorted((r.score, truth[r.doc_id]) for r in held)
    below = 0
    area = 0
    for _, label in scores:
        below += 1 - label
        area += below * label
    assert area / (len(caught) * len(clean)) > 0.97


def _plain_count(scores):
    """Tokens of a marked word by a plain search over all splits."""
    import functools

    longest, floor = max(map(len, scores)), min(scores.values()) - 10

    @functools.cache
    def best(word):
        top = [(0.0, 0)]
        for stop in range(1, len(word) + 1):
            found = (-1e18, 0)
            for start in range(max(0, stop - longest), stop):
                score = scores.get(word[start:stop])
                if score is not None and top[start][0] + score > found[0]:
                    found = (top[start][0] + score, top[start][1] + 1)
            size = len(word[stop - 1].encode())
            if word[stop - 1] not in scores and top[-1][0] + size * floor > found[0]:
                found = (top[-1][0] + size * floor, top[-1][1] + size)
            top.append(found)
        return top[-1][1]

    return best


def test_token_counts_of_every_document(spark, documents):
    from voltaic.llm import token_counts as tc

    best = _plain_count(tc.piece_scores(tc.read_pieces(public_tokenizers.path(PIECE_VOCABULARY))))
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in QUERIES["op6_token_counts"](spark, SF_SMALL).collect()}
    split = {doc: (text or "").split() for doc, text, _ in documents}
    assert got == {doc: (len(words), sum(best("▁" + w) for w in words)) for doc, words in split.items()}


def test_token_counts_of_long_words(monkeypatch):
    """Words above MAX_BATCH_WORD through a trie that is emptied again and again."""
    import random

    from voltaic.llm import token_counts as tc

    scores = tc.piece_scores(tc.read_pieces(public_tokenizers.path(PIECE_VOCABULARY)))
    best, rng = _plain_count(scores), random.Random(8)
    pieces = [p.strip("▁") or "a" for p in rng.sample(sorted(scores), 300)] + ["😀", "é", "日本", "ẞ"]
    words = ["".join(rng.choices(pieces, k=rng.randint(10, 60))) for _ in range(60)]
    words = [w for w in words if len(w) > tc.MAX_BATCH_WORD]
    words += [words[0] + "s", words[0][:60], "x" * 49, "x" * 48, "x" * 700]
    resets = []
    clear = tc.Trie.clear
    monkeypatch.setattr(tc, "MAX_NODES", 400)
    monkeypatch.setattr(tc.Trie, "clear", lambda self: resets.append(1) or clear(self))
    counter = tc.BatchCounter(scores)
    for _ in range(2):
        assert counter.count(set(words)) == {w: best("▁" + w) for w in words}
        counter.cache = tc.Cache(10)
    assert len(resets) > 10


def test_language_query_against_plain_counts(spark, documents):
    """Naive Bayes n-gram by n-gram: language and score of every document of the fixture."""
    from collections import Counter

    def grams(text):
        line, low = "", (text or "").lower()
        for ch in low:
            line += ch if ch.isalpha() else " " * (line[-1:] not in ("", " "))
        for order in (1, 2, 3, 4):
            for at in range(len(line) - order + 1):
                h = order
                for ch in line[at : at + order]:
                    h = (h ^ ord(ch)) * 0x9E3779B1 & 0xFFFFFFFF
                    h ^= h >> 15
                yield (h * 0x85EBCA6B & 0xFFFFFFFF) >> 16

    held = {doc: zlib.crc32(str(doc).encode()) % 4 == 2 for doc, _, _ in documents}
    every = {doc: Counter(grams(text)) for doc, text, _ in documents}
    names = sorted({lang for doc, text, lang in documents if not held[doc] and lang and text is not None})
    own = {n: Counter() for n in names}
    prior = Counter()
    for doc, text, lang in documents:
        if not held[doc] and lang and text is not None:
            own[lang].update(every[doc])
            prior[lang] += 1
    total = {n: sum(own[n].values()) + 0.5 * 65536 for n in names}
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, SF_SMALL).collect()}
    assert len(got) == len(documents)
    for doc, _, _ in documents:
        logs = [np.log(prior[n] / prior.total()) + sum(
            k * float(np.float32(np.log(own[n][g] + 0.5) - np.log(total[n]))) for g, k in every[doc].items()) for n in names]
        many = every[doc].total()
        scaled = (np.array(logs) - max(logs)) * min(1, 100 / max(1, many))
        assert got[doc].lang_pred == (names[int(np.argmax(logs))] if many else "und")
        assert abs(got[doc].score - (1 / np.exp(scaled).sum() if many else 0)) < 1e-6


def test_toxicity_query_against_plain_search(spark, documents):
    """Every entry and exception phrase looked up one by one in every document of the fixture."""
    from voltaic.llm import toxicity
    from voltaic.llm.common import id_bucket, read_table

    held_out = id_bucket("doc_id", 3) == 1
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    model = toxicity.fit(docs.where(~held_out), read_table(spark, SF_SMALL, "labels").where(~held_out))
    assert model.entries

    def places(line, phrase):
        at = line.find(phrase)
        while at >= 0:
            yield at, at + len(phrase)
            at = line.find(phrase, at + 1)

    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, SF_SMALL).collect()}
    for doc, text, _ in documents:
        own = toxicity.fold(text)
        line = " " + " ".join(own) + " "
        spared = [p for phrase in model.exceptions for p in places(line, " " + " ".join(toxicity.fold(phrase)) + " ")]
        best, hits = {}, 0
        for entry, weight in model.entries.items():
            for a, b in places(line, entry):
                if not any(x <= a and b <= y for x, y in spared):
                    best[a] = max(best.get(a, 0.0), weight)
                    hits += 1
        weight = sum(best[a] for a in sorted(best))
        x = model.curve[0] + model.curve[1] * np.log1p(weight) + model.curve[2] * np.log1p(1000 * weight / max(1, len(own)))
        score = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        assert got[doc].n_hits == hits and abs(got[doc].score - score) < 1e-9 and got[doc].predicted == (score >= 0.7)
