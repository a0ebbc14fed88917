"""Language, spelling variants and fill-in-middle against brute force, and their odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagelore.llm import fim, langid, queries, spelling

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the added ones."""
    rows = [
        (1, None, None), (2, "", "en"), (3, " \n\t\n", "en"), (None, "a\nb\n", None), (4, "same\ntext", "de"),
        (4, "same\ntext", "de"), (5, "with <S> mark\n", "de"), (6, "x" * 300_000, "en"),
        (7, "é ß 漢字\n\U0001f600 don't\n" * 2000, "fr"), (8, "12 34 !\n", "fr"), (9, "\n" * 50_000 + "end", ""),
    ]
    names = "doc_id long, text string, lang string, N long, output string, rest string, score int, `a.b` int"
    return spark.createDataFrame([(*row, 1, "o", "r", 2, 3) for row in rows], names)


# --- fill-in-middle ----------------------------------------------------------------------


def brute_fim(doc_id, text, percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm_percent:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, len(prefix), len(middle), output


@pytest.mark.parametrize("settings", [{}, {"percent": 40, "spm_percent": 90}])
def test_fill_in_middle(real, odd, settings):
    for table in (real, odd):
        made = fim.fill_in_middle(table, **settings)
        assert [c for c in made.columns if c not in ("n", "form", "prefix_chars", "middle_chars", "output")] == [
            c for c in table.columns if c.lower() not in ("n", "output")
        ]
        back = fim.restored(F.col("output"), F.col("form"))
        found = made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", back.alias("back"))
        rows = found.collect()
        assert len(rows) == table.count()
        for r in rows:
            expected = brute_fim(r.doc_id, r.text, **settings)
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected
            assert r.back == (r.text or "")
    assert fim.fill_in_middle(odd.where("false")).count() == 0


def test_fill_in_middle_query(spark, real):
    found = {r.doc_id: r for r in queries.QUERIES["op13_fill_in_middle"](spark, SF_DIR).collect()}
    rows = real.collect()
    assert len(found) == len(rows)
    sha = lambda text: hashlib.sha256((text or "").encode()).hexdigest()
    for r in rows:
        n, form, prefix, middle, output = brute_fim(r.doc_id, r.text)
        assert tuple(found[r.doc_id]) == (r.doc_id, n, form, prefix, middle, sha(output), sha(r.text))


def test_rank_index():
    rng = np.random.default_rng(1)
    steps = [rng.integers(0, 100, 5000), np.zeros(300, int), rng.integers(0, 10**6, 500), np.full(1000, 7), [0], []]
    for step in [*steps, np.concatenate(steps[:4])]:
        offsets = np.cumsum(np.array(step, dtype=np.int64))
        for error in (0, 1, 50, fim.ERROR):
            index = fim.RankIndex.fit(offsets, error)
            ranks = rng.permutation(len(offsets))
            assert index.offsets(ranks).tolist() == offsets[ranks].tolist()
            assert not len(offsets) or np.abs(index.residuals.astype(int)).max() <= error + 1
            if error == fim.ERROR and len(offsets) == 5000:
                assert len(index.first) == 1
    with pytest.raises(ValueError):
        fim.RankIndex.fit(offsets, fim.ERROR + 1)


# --- language ----------------------------------------------------------------------------


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text or "").split()
    lower = lambda w: "".join(c.lower() if len(c.lower()) == 1 else c for c in w)
    for word in (f" {lower(w)} " for w in words):
        for order in langid.ORDERS:
            for i in range(len(word) - order + 1):
                yield word[i : i + order]


def bucket_of(gram, buckets):
    value = len(gram)
    for c in gram:
        value = (value * int(langid._PRIME) + (0 if c == " " else ord(c))) % 2**64
    return int(langid.mix(np.array([value], dtype=np.uint64))[0]) % buckets


def brute_languages(train, texts, buckets):
    """Counts and sums gram by gram, in plain Python."""
    counts, docs = {}, Counter()
    for text, lang in train:
        found = Counter(bucket_of(g, buckets) for g in brute_grams(text))
        if lang is not None and found:
            counts.setdefault(lang, Counter()).update(found)
            docs[lang] += 1
    languages, s = sorted(counts), langid.SMOOTHING
    whole = lambda p: int(np.rint(np.log(p) * 65536))
    total = {lang: sum(counts[lang].values()) + s * buckets for lang in languages}
    result = []
    for text in texts:
        grams = [bucket_of(g, buckets) for g in brute_grams(text)]
        if not grams or not languages:
            result.append(("und", 0.0))
            continue
        sums = [
            whole((docs[lang] + s) / (sum(docs.values()) + s * len(languages)))
            + sum(whole((counts[lang][b] + s) / total[lang]) for b in grams)
            for lang in languages
        ]
        best = max(range(len(languages)), key=lambda i: (sums[i], -i))
        result.append((languages[best], 1 / sum(np.exp((x - sums[best]) / 65536) for x in sums)))
    return result


def test_language_against_brute_force(spark, real, odd):
    rows = real.orderBy("doc_id").limit(40).collect()
    long = [(r.doc_id, r.text, r.lang) for r in odd.collect() if len(r.text or "") < 1000]
    table = [(r.doc_id, r.text, r.lang) for r in rows] + long
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    model = langid.fit(docs, usable=~langid.held_out(F.col("doc_id")), buckets=512)
    train = [(t, lang) for d, t, lang in table if zlib.crc32(str(d).encode()) % 3 != 1 or d is None]
    expected = brute_languages(train, [t for _, t, _ in table], 512)
    found = langid.with_language(docs, model, ["doc_id", "text"]).collect()
    by_row = {(str(r.doc_id), r.text): (r.lang_pred, r.score) for r in found}
    assert len(found) == len(table)
    for (doc_id, text, _), (lang, score) in zip(table, expected):
        assert by_row[str(doc_id), text] == (lang, pytest.approx(score, rel=1e-9))


def test_language_of_held_out_rows(spark, real):
    lang = {r.doc_id: (r.lang, r.text) for r in real.collect()}
    found = queries.QUERIES["op11_language_id"](spark, SF_DIR).collect()
    assert len(found) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out and re.search(r"[^\W\d_]", lang[r.doc_id][1] or "")]
    right = sum(r.lang_pred == lang[r.doc_id][0] for r in held)
    assert held and right >= 0.95 * len(held)


def test_language_odd_rows(spark, odd):
    model = langid.fit(odd)
    found = langid.with_language(odd, model, ["doc_id", "N", "output"]).collect()
    assert len(found) == odd.count()
    unknown = {1, 2, 3, 8}
    for r in found:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in unknown)
    assert set(model.languages) == {"", "de", "en", "fr"}
    for nothing in (odd.where("false"), odd.where("doc_id in (1, 2, 3, 8)"), odd.where("lang is null")):
        blank = langid.fit(nothing)
        assert {(r.lang_pred, r.score) for r in langid.with_language(odd, blank, ["doc_id"]).collect()} == {("und", 0.0)}
    assert langid.with_language(odd.where("false"), model, ["doc_id"]).count() == 0
    labels = spark.range(600).select(F.col("id").cast("string").alias("lang"), F.lit("a").alias("text"))
    with pytest.raises(ValueError):
        langid.fit(labels)


def test_ngrams_do_not_depend_on_blocks(monkeypatch):
    text = "Größe über alles 漢字 mit İ und\tﬁ " * 50
    column = pa.array([text, None, "x", text[:77]])
    gather = lambda: sorted(zip(*(np.concatenate(x).tolist() for x in zip(*langid.ngrams(column)))))
    whole = gather()
    monkeypatch.setattr(langid, "BLOCK", 16)
    assert gather() == whole
    assert whole == sorted((i, bucket_of(g, langid.BUCKETS)) for i, t in enumerate(column.to_pylist()) for g in brute_grams(t))


# --- spelling variants -------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=2):
    near = {w: [] for w in counts}
    by_rest = {}
    for w in counts:  # words that share a rest after leaving out one symbol, then the real test
        for i in range(len(w) + 1):
            by_rest.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for group in by_rest.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b)]
    near = {w: set(x) for w, x in near.items()}
    best = {w: min(x, key=lambda y: (-counts[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if counts[b] >= ratio * counts[w]}
    rows = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(rows)


def brute_words(rows, noise=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


FIELDS = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_query(spark, real):
    found = queries.QUERIES["op12_spelling_variants"](spark, SF_DIR)
    assert found.columns == list(FIELDS)
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == brute_variants(brute_words([(r.doc_id, r.text) for r in real.collect()]))
    assert any(r[1] for r in rows)


@pytest.mark.parametrize("state_words", [2, 5, spelling.STATE_WORDS])
def test_spelling_variants(spark, state_words):
    """All words over few letters, repeated letters, and long ones; states are split or not."""
    rnd = random.Random(state_words)
    words = {"".join(rnd.choices("ab", k=rnd.randint(1, 6))) for _ in range(90)}
    words |= {"aaaaé" + "".join(rnd.choices("abcé÷", k=rnd.randint(0, 5))) for _ in range(150)}
    long = "ab" * (1500 if state_words > 5 else 4)
    words |= {long, long[:-1], "x" + long, long[:7] + "c" + long[8:], "aaaa", "aaa", "a", "b"}
    counts = {w: rnd.choice([1, 1, 2, 3, 5, 8, 20, 100, 10**12]) for w in words}
    table = spark.createDataFrame([*counts.items(), (None, 5), ("", 9), ("zz", None)], "word string, n long")
    found = spelling.spelling_variants(table, state_words=state_words).select(*FIELDS)
    assert sorted(tuple(r) for r in found.collect()) == brute_variants(counts)


def test_spelling_chain_and_odd_rows(spark, odd):
    chain = [("a" * (70 - i), 3 * 2**i) for i in range(60)]
    table = spark.createDataFrame([*chain, chain[0]], "word string, n long").withColumn("root", F.lit(1))
    found = {r.word: r for r in spelling.spelling_variants(table).collect()}
    assert len(found) == 60 and found[chain[1][0]].root == chain[-1][0]
    assert found[chain[0][0]].n == 6 and found[chain[0][0]].form is None  # the row that came twice
    words = spelling.word_occurrences(odd, noise=97)
    assert words.count() == sum(len(re.findall("[A-Za-zÀ-ÿ]+", r.text or "")) for r in odd.collect())
    for nothing in (odd.where("false"), odd.where("text is null")):
        empty = spelling.vocabulary(spelling.word_occurrences(nothing))
        assert spelling.spelling_variants(empty).count() == 0


def test_acceptor_is_minimal():
    words = sorted({"tap", "taps", "top", "tops", "tip", "tips"})
    v = spelling.Acceptor()
    root = v.root(words)
    assert v.count[root] == 6 and len(v.arcs) == 5  # root, t, a vowel, p, s
    ranks = []
    for word in words:
        state, rank = root, 0
        for c in word:
            state, before = v.arcs[state][c]
            rank += before
        ranks.append(rank)
    assert ranks == list(range(6))
