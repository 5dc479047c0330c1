"""Whitening, personal data and tokenizer alignment: whole queries against brute force, and every odd input."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltaic.llm import alignment, pii, whitening
from voltaic.llm.queries import BYTE_TOKENIZER, PIECE_VOCABULARY, QUERIES

PATHS = {"path_a": public_tokenizers.path(BYTE_TOKENIZER), "path_b": public_tokenizers.path(PIECE_VOCABULARY)}


# ---- whitening ----


def plain_whitening(vectors, count=32):
    """Eigenvectors by numpy, over the same whole numbers."""
    x = np.floor(64 * np.array(vectors, np.float64)) + 1_000_000
    centred = x - x.mean(axis=0)
    values, turned = np.linalg.eigh(centred.T @ centred / len(x))
    values, turned = values[::-1][:count], turned[:, ::-1][:, :count]
    whole = x.astype(np.int64)
    deviation = ((len(x) * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    return centred @ turned / np.sqrt(values), values / np.trace(centred.T @ centred / len(x)), deviation


def test_whitening_query_against_numpy(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet' ORDER BY vec_id").fetchall()
    want, explained, deviation = plain_whitening([r[1] for r in rows])
    got = QUERIES["op11_whitening"](spark, SF_SMALL).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 32 * len(rows) and set(got.n) == {len(rows)} and got.identity_error.max() <= 1e-10
    made = got.whitened.to_numpy().reshape(-1, 32)
    sign = np.sign((made * want).sum(axis=0))
    assert np.abs(made * sign - want).max() < 1e-8
    assert np.allclose(got.explained.to_numpy().reshape(-1, 32), explained, rtol=1e-9)
    assert got.deviation.to_numpy().reshape(-1, 32)[:, 0].tolist() == deviation.tolist()


def matrices():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield "spread", (turn * np.geomspace(1, 1e-6, 40)) @ turn.T
    yield "ties", (turn * np.repeat([5.0, 3.0, 1.0, 0.5], 10)) @ turn.T
    yield "identity", np.eye(40)
    for gap in (1e-6, 1e-9, 1e-11, 1e-12, 1e-14):
        yield f"gap {gap}", (turn * (1 + gap * np.arange(40))) @ turn.T
    low = rng.standard_normal((7, 40))
    yield "rank 7", low.T @ low
    yield "one", np.array([[2.0]])


@pytest.mark.parametrize("name,matrix", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_leading_eigenpairs(name, matrix):
    matrix = (matrix + matrix.T) / 2
    true = np.linalg.eigvalsh(matrix)[::-1]
    values, vectors = whitening.leading(matrix, 12)
    assert len(values) == min(12, (true > 1e-9).sum()) and (np.diff(values) <= 1e-10).all()
    assert np.allclose(values, true[: len(values)], rtol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-5
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-9


def test_inertia_counts():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 8, 21):
        half = rng.standard_normal((size, size))
        matrix = half + half.T
        np.fill_diagonal(matrix, 0)  # no pivot of one row fits at first
        true = np.linalg.eigvalsh(matrix)
        for shift in [0.0, *((true[1:] + true[:-1]) / 2), true[0] - 1, true[-1] + 1]:
            if np.abs(true - shift).min() > 1e-9:
                assert whitening.above(matrix, shift) == (true > shift).sum()
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    good += [(None, good[0][1]), (3, good[3][1]), (3, good[3][1])]
    bad = [(90, None), (91, []), (92, [1.0] * 4), (93, [1.0, None, 2.0, 3.0, 4.0]), (94, [float("nan")] * 5),
           (95, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("deviation", F.lit("x"))
    got = whitening.whiten(table).toPandas()
    assert len(got) == 5 * len(good) and got.identity_error.max() < 1e-12 and got.id.isna().sum() == 5
    want, explained, _ = plain_whitening([g[1] for g in good])
    assert np.isclose(sorted(got.whitened.abs()), sorted(np.abs(want).reshape(-1))).all()
    assert np.allclose(got.groupby("component").explained.first(), explained)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id >= 90 and vec_id != 92")).count() == 0
    # one row, and constant dimensions: nothing to scale by
    single = whitening.whiten(table.where("vec_id = 0")).collect()
    assert len(single) == 5 and all(r.whitened is None and r.deviation == 0 and r.identity_error is None for r in single)
    flat = table.where("vec_id < 30").withColumn("embedding", F.expr("transform(embedding, (x, i) -> if(i < 2, x, 0.5D))"))
    got = whitening.whiten(flat).toPandas()
    assert got[got.component <= 2].whitened.notna().all() and got[got.component > 2].whitened.isna().all()


def test_whitening_of_extreme_entries(spark):
    """Sums of products beyond a long, a deviation beyond it, and too many dimensions."""
    rows = [(i, [float(i) * 1e9, 1.0 + i % 3]) for i in range(6)] + [(9, [1e300, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 14 and {r.deviation for r in got if r.id == 9} == {None}
    # the other dimension's variance is below the rounding error of the matrix
    assert all((r.whitened is None) == (r.component == 2) for r in got)
    small = spark.createDataFrame(rows[:6], "vec_id long, embedding array<double>")
    x = [[int(64 * i * 1e9), 64 * (1 + i % 3)] for i in range(6)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((6 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for i, row in enumerate(x)}
    got = {r.id: r.deviation for r in whitening.whiten(small).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in want.items()}
    wide = spark.createDataFrame([(1, [0.0] * (whitening.MAX_DIMENSION + 1))], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(wide)


# ---- personal data ----


def plain_spans(text):
    """Base spans by the plain patterns and by arithmetic on the matches."""
    text, out = text or "", []
    for kind in pii.BASE:
        for m in re.finditer(kind.pattern, text, re.A):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind.name == "ip":
                ok = all(int(p) <= 255 for p in m.group().split("."))
            elif kind.name == "card":
                doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
                ok = 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            else:
                ok = kind.name == "email" or 9 <= len(digits) <= 15
            if ok:
                out.append((kind.name, m.start(), m.end()))
    return out


def found(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(table).collect()
    return {r.doc_id: [(s.kind, s.start, s.stop, s.base) for s in r.spans] for r in rows}


PIECES = ["a@b.c", "x.y@", "@", ".", "-", "1", "42", "255", "256", "0009", " ", "+", "(", ")", "4111 1111 1111 1111", "+1 (017) 555-7713",
          "é", "😀", "\n", "٣", "%", "_", "1.2.3.4", "user_1@mail-x.co.uk", "5500-0000-0000-0004", "Z"]


def test_personal_data_against_plain_patterns(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [None, ""]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert [s[:3] for s in got[i] if s[3]] == plain_spans(text), text


def test_personal_data_in_long_texts(spark):
    """Runs that a careless pattern reads again and again, or recurses into, and many matches in one text."""
    mails, parts = 20_000, 40_000
    texts = ["a" * 400_000 + "@", "1" * 400_000, "1 " * 200_000, "+1" + "(" * 300_000, "A" * 300_000 + "GB82",
             "9." * parts, "a.b@c" * mails, "😀 1.2.3.4 " * 10_000, "x@y" + ".z" * 200_000]
    got = found(spark, texts)
    assert all(got[i] == [] for i in range(5))
    assert plain_spans("9." * 40) == [("ip", 8 * i, 8 * i + 7) for i in range(10)]
    assert [s[:3] for s in got[5]] == [("ip", 8 * i, 8 * i + 7) for i in range(parts // 4)]
    few = plain_spans("a.b@c" * 40)
    assert few == [("email", 0, 8)] + [("email", 9 + 10 * i, 18 + 10 * i) for i in range(len(few) - 1)]
    many = [s[:3] for s in got[6]]
    assert many == [("email", 0, 8)] + [("email", 9 + 10 * i, 18 + 10 * i) for i in range(len(many) - 1)]
    assert len(many) - len(few) == (mails - 40) // 2
    assert [s[:3] for s in got[7]] == [("ip", 2 + 10 * i, 9 + 10 * i) for i in range(10_000)]
    assert [s[:3] for s in got[8]] == [("email", 0, 400_003)]


def test_personal_data_added_kinds(spark):
    texts = ["my iban GB82 WEST 1234 5698 7654 32.", "GB82WEST12345698765432", "GB83WEST12345698765432", "xGB82WEST12345698765432",
             "ssn: 219-09-9999", "219-09-9999", "order 219-09-9999", "ssn 000-12-3456", "ssn 1219-09-9999", "DE89370400440532013000 account"]
    got = found(spark, texts)
    assert [[s[0] for s in got[i] if not s[3]] for i in range(len(texts))] == [
        ["iban"], ["iban"], [], [], ["ssn"], [], [], [], [], ["iban"]]
    assert got[0][0][1:3] == (8, 35)
    table = spark.createDataFrame([(0, "call +1 (017) 555-7713")], "doc_id long, text string")
    assert pii.find(table).first().spans[0].score == 0.9
    assert [s.kind for s in pii.find(spark.createDataFrame([(0, texts[5])], "doc_id long, text string"), threshold=0.4).first().spans] == ["ssn"]


def test_personal_data_odd_tables(spark):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"), (2, None), (3, "")]
    table = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, spans string, kind string, `a.b` string")
    out = pii.find(table)
    assert out.columns == ["doc_id", "text", "kind", "a.b", "spans"] and out.count() == 5
    listed = sorted((str(r.doc_id), r.n_email, r.spans) for r in pii.digest(out).collect())
    assert listed == [("1", 1, "email:0:5"), ("1", 1, "email:0:5"), ("2", 0, ""), ("3", 0, ""), ("None", 1, "email:0:5")]
    assert pii.digest(pii.find(table.limit(0))).count() == 0
    plan = pii.digest(out)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ---- alignment ----


def plain_alignment(docs):
    """Document by document, link by link."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(PATHS["path_a"])
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PATHS["path_b"])
    alphabet = alignment.byte_alphabet()
    made, held = [], Counter()
    for text in docs:
        a = b = []
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            spelled = [[bytes(alphabet[c] for c in a_model.id_to_token(i)) for i in a],
                       [alignment.piece_bytes(b_model.id_to_piece(i)) for i in b]]
            if not b"".join(spelled[0]) == b"".join(spelled[1]) == (" " + text).encode():
                a = b = []
        if not a:
            made.append(((0, 0, 0, 0), "", []))
            continue
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in spelled]
        links, j = [], 0
        for i, stop in enumerate(ends[0]):
            start = ends[0][i - 1] if i else 0
            while ends[1][j] <= start:
                j += 1
            k = j
            while k < len(b) and (ends[1][k - 1] if k else 0) < stop:
                links.append((a[i], b[k]))
                k += 1
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, p, q = [], 0, 0
        for cut in both:
            x, y = ends[0].index(cut, p) + 1, ends[1].index(cut, q) + 1
            groups.append(",".join(map(str, a[p:x])) + "|" + ",".join(map(str, b[q:y])))
            p, q = x, y
        made.append(((len(a), len(b), len(both), len(links)), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
        held.update(set(links))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [(*c, sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), d) for c, d, links in made]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    want = dict(zip([d[0] for d in docs], plain_alignment([d[1] for d in docs]), strict=True))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_alignment"](spark, SF_SMALL).collect()}
    assert got == want


def test_alignment_of_odd_texts(spark, monkeypatch):
    rng = random.Random(5)
    texts = [None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b \tc", "it's <|endoftext|> here", "<s> </s> <unk>", "▁", "a ▁ b", "x▁y",
             "日本語 のテスト", "😀😀 é é", "\x00\x1c \x85 　z", "ﬁ ① Ⅷ", "one two three", "one two three", "ab" * 30_000, "word " * 20_000]
    texts += ["".join(rng.choice(["a", "the ", " ", "\n", "é", "1", "’", "'s", "▁", "ll", "\t", "​", "Ω"]) for _ in range(30)) for _ in range(120)]
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, block string, id string")
    want = sorted(((i, *w) for i, w in zip(ids, plain_alignment(texts), strict=True)), key=str)
    for kept in (300_000, 5):
        monkeypatch.setattr(alignment, "KEPT_CUTS", kept)
        got = alignment.align(table, **PATHS)
        assert sorted(((r.id, *(r[c] for c in COLUMNS)) for r in got.collect()), key=str) == want
    assert alignment.align(table.limit(0), **PATHS).count() == 0
    assert alignment.align(table.where("text is null or text = ''"), **PATHS).agg(F.sum("count_sum")).first()[0] == 0


def test_alignment_blocks_do_not_matter(spark, monkeypatch):
    """Small blocks in the workers' own function give the counts of large ones."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["sun", "moonlight", "Straße", "été", "x1"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(23)
    want = dict(enumerate(plain_alignment(texts)))
    got = {r.id: tuple(r[c] for c in COLUMNS) for r in alignment.align(table, **PATHS).collect()}
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 8), st.integers(1, 8), st.integers(1, 8), st.integers(0, 2**32 - 1))
def test_sparse_product_equals_dense(rows, inner, cols, seed):
    rng = np.random.default_rng(seed)

    def sparse(dense):
        at = [np.flatnonzero(r) for r in dense]
        ptr = np.concatenate([[0], np.cumsum([len(x) for x in at])])
        return alignment.Csr(ptr, np.concatenate(at).astype(np.int64), dense[dense != 0], dense.shape[1])

    left, right = (rng.integers(0, 3, s) for s in ((rows, inner), (inner, cols)))
    made = alignment.product(sparse(left), sparse(right))
    dense = np.zeros((rows, cols), np.int64)
    dense[made.rows(), made.cols] = made.values
    assert (dense == left @ right).all()
    turned = sparse(left).transposed()
    assert (np.diff(turned.ptr) == (left != 0).sum(axis=0)).all() and turned.height == inner


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40)))
def test_links_of_token_ends(first, second):
    ends = [np.array(sorted(s | {41})) for s in (first, second)]
    starts = [np.concatenate([[0], e[:-1]]) for e in ends]
    want = [(i, j, min(x, y) - max(a, b)) for i, (a, x) in enumerate(zip(starts[0], ends[0], strict=True))
            for j, (b, y) in enumerate(zip(starts[1], ends[1], strict=True)) if max(a, b) < min(x, y)]
    assert list(zip(*(x.tolist() for x in alignment.overlap_links(*ends)), strict=True)) == want
    group = [np.searchsorted(alignment.common_ends(*ends), e) for e in ends]
    shared = [(i, j) for i, g in enumerate(group[0]) for j, h in enumerate(group[1]) if g == h]
    for most in (1, 3, 1000):
        got = [pair for a, b in alignment.group_links(*ends, most=most) for pair in zip(a.tolist(), b.tolist(), strict=True)]
        assert got == shared
    assert alignment.count_group_links(*ends).tolist() == [int((group[1] == g).sum()) for g in group[0]]
