"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_operators import SF, frame
from tidemark.llm import spelling as S


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def edited_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def brute_variants(counts):
    # words one apart share a text with one letter left out, or one is that text of the other
    holes = {}
    for w in counts:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holes.setdefault(form, set()).add(w)
    near = {w: set() for w in counts}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(map(str, out))


def plain(rows):
    return sorted(map(str, map(tuple, rows)))


def random_words(seed, n, letters="abé", low=2, high=9):
    draw = random.Random(seed)
    return {"".join(draw.choice(letters) for _ in range(draw.randint(low, high))): draw.randint(3, 60) for _ in range(n)}


def test_suffixes_are_in_order():
    text = S.codes(["aaaaaaaaaaaaaaaaaaaaaaaaaaaab", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ab", "ÿé"])
    whole = [*text.tolist(), -1]
    assert S.suffix_order(text).tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_word_one_error_away_once(seed):
    words = sorted(random_words(seed, 300))
    index = S.WordIndex(words)
    queries = [w for w in words if len(w) > 1] + ["aaéa", "bbbbb"]
    for right in (True, False):
        query, word = index.near(queries, right)
        got = list(zip(query.tolist(), word.tolist(), strict=True))
        assert len(got) == len(set(got))
        for q, w in enumerate(queries):
            half = len(w) // 2
            same = (lambda v, w=w, half=half: v.startswith(w[:half])) if right else (lambda v, w=w, half=half: v.endswith(w[half:]))
            near = {i for i, v in enumerate(words) if one_apart(w, v)}
            found = {v for a, v in got if a == q}
            assert found <= near and {i for i in near if same(words[i])} >= found
        if right:
            first = set(got)
    assert {(q, i) for q, w in enumerate(queries) for i, v in enumerate(words) if one_apart(w, v)} == first | set(got)


@pytest.mark.parametrize("options", [{}, {"index_symbols": 40, "half_words": 7}])
def test_variants_equal_comparing_all_words(spark, options):
    counts = random_words(9, 900) | {"ÿéàçö": 5, "ÿéàçõ": 9, "x" * 300: 4, "x" * 301: 8, "colour": 6, "color": 3, "colr": 12}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(7)
    assert plain(S.variants(words, **options).collect()) == brute_variants(counts)


def test_words_are_counted_as_read(spark, monkeypatch):
    texts = [None, "", "12 34", "Hello hello HELLO wörld×÷ß " * 40, "ÀÉabc àÉABC " * 9, "a" * 90 + " " + "b" * 63 + " " + "B" * 64, "Straße日本straße naïve_NAÏVE"] * 30
    texts += [" ".join(f"variant{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(k, 400)) for k in range(0, 60)]
    ids = [None if i % 9 == 4 else i * 13 for i in range(len(texts))]
    rows = list(zip(ids, texts, strict=True))
    want = sorted(edited_words(rows).items())
    assert sorted(map(tuple, S.corpus_words(frame(spark, texts, ids)).collect())) == want
    held = S.WordCounts()
    monkeypatch.setattr(S, "HELD_WORDS", 50)
    monkeypatch.setattr(S, "LONG_TEXT", 100)
    held.add(["" if i is None else str(i) for i in ids], [None if t is None else t.encode() for t in texts])
    got = held.take().to_pydict()
    assert sorted((w, n) for w, n in zip(got["word"], got["n"], strict=True) if n >= 3) == want


def test_registered_query_on_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = S.op11_spelling_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert plain(got.collect()) == brute_variants(edited_words(rows))


def test_no_words_give_no_rows(spark):
    none = frame(spark, ["one two", None, ""])
    assert S.variants(S.corpus_words(none)).count() == 0 and S.variants(S.corpus_words(none.limit(0))).count() == 0
    assert np.all(S.codes([]) == S.DELIMITER)
