"""The trained operators against plain Python versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm.test_operators import documents
from tidewright.llm.language import identify_language
from tidewright.llm.quality import STATISTICS, classify_quality

CLASSES = [b" \t\x0b\x0c\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"!#$%&*+/<=>@[\\]^_`{|}~", bytes(range(0x80, 0x100))]


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def statistics(text):
    data = (text or "").encode()
    share = lambda some: math.sqrt(sum(b in some for b in data) / max(len(data), 1))
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    n = max(len(words), 1)
    lines = [tuple(w) for w in (re.findall(rb"[^\x20\x09-\x0D]+", line) for line in data.split(b"\n")) if w]
    mean = sum(map(len, words)) / n
    spread = math.sqrt(max(sum(len(w) ** 2 for w in words) / n - mean**2, 0))
    of_words = lambda ok: math.sqrt(sum(map(ok, words)) / n)
    pairs = list(zip(words, words[1:], strict=False))
    bins = Counter(b >> 2 for b in data)
    return dict(zip(STATISTICS, [
        math.log1p(len(words)), math.log1p(len(lines)), math.log1p(mean), math.log1p(spread), share(CLASSES[0]), *[share(CLASSES[k]) for k in (2, 3, 4, 5, 6, 7)],
        of_words(lambda w: len(w) <= 3), of_words(lambda w: len(w) > 12), of_words(lambda w: w[-1] in CLASSES[6]), of_words(lambda w: w[0] in CLASSES[6] and w[-1] in CLASSES[6]), len(set(words)) / n,
        math.sqrt(1 - len(set(pairs)) / len(pairs)) if pairs else 0.0, math.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0, math.log1p(len(words) / max(len(lines), 1)),
        -sum(c / len(data) * math.log2(c / len(data)) for c in bins.values()),
    ], strict=True))


def test_quality_equals_the_formula(spark):
    rng = random.Random(2)
    rows = documents(7, 120) + [(5000, "very long " * 20_000), (5001, "same\nline\n" * 30)]
    labels = {d: int(rng.random() < (0.8 if t and len(t) > 200 else 0.2)) for d, t in rows}
    x = {d: np.array(list(statistics(t).values())) for d, t in rows}
    learn = [d for d, _ in rows if not held(d)]
    own = {c: np.array([x[d] for d in learn if labels[d] == c]) for c in (0, 1)}
    cov = {c: np.cov(v.T, bias=True) for c, v in own.items()}
    pooled = sum(cov[c] * len(own[c]) for c in (0, 1)) / len(learn)
    score = {}
    for d in x:
        log = []
        for c in (0, 1):
            s = 0.9 * cov[c] + 0.1 * pooled + 1e-4 * np.eye(len(STATISTICS))
            away = x[d] - own[c].mean(axis=0)
            log.append(math.log(len(own[c]) / len(learn)) - 0.5 * (np.linalg.slogdet(s)[1] + away @ np.linalg.inv(s) @ away))
        score[d] = 1 / (1 + math.exp(min(700, max(-700, log[0] - log[1]))))
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string")
    got = classify_quality(docs, spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int")).collect()
    # The repeated row is learnt from twice, so it is left out of what is compared closely.
    assert len(got) == len(rows) + 1 and all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) for r in got)
    once = {r.doc_id: r.score for r in classify_quality(docs.limit(0).unionByName(spark.createDataFrame(rows, "doc_id bigint, text string")), spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int")).collect()}
    assert max(abs(once[d] - score[d]) for d in score) < 1e-6


def grams(word, n):
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def test_language_equals_the_formula(spark):
    rng = random.Random(4)
    letters = {"aa": "abcdefg", "bb": "defghij", "cc": "hijklmö"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 6)))
    rows = []
    for d in range(200):
        lang = rng.choice(sorted(letters))
        rows.append((d, " ".join(word(lang) for _ in range(rng.randint(1, 25))) + "! 12", lang))
    rows += [(900, "abc " * 60_000, None), (901, "xyz", None), (902, "12", "aa"), (903, None, "bb"), (904, "Ö-h", None)]
    words = {lang: Counter(w for d, t, x in rows if x == lang and t and not held(d) for w in re.findall(r"[^\W\d_]+", t.lower())) for lang in letters}
    tables = {n: {lang: Counter() for lang in letters} for n in range(5)}
    for lang, found in words.items():
        tables[0][lang] = found
        for n in range(1, 5):
            for w, c in found.items():
                for g in grams(w, n):
                    tables[n][lang][g] += c
    total = {n: {lang: sum(t[lang].values()) for lang in letters} for n, t in tables.items()}
    value = lambda n, g, lang: math.log((tables[n][lang][g] or 0.5) / (total[n][lang] + 1))
    known = lambda n, g: any(g in tables[n][lang] for lang in letters)

    def scored(text):
        sums = dict.fromkeys(sorted(letters), 0.0)
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not found:
            return "und", 0.0
        for w in found:
            if known(0, w):
                for lang in sums:
                    sums[lang] += value(0, w, lang)
                continue
            for n in range(4, 0, -1):
                if some := [g for g in grams(w, n) if known(n, g)]:
                    for lang in sums:
                        sums[lang] += sum(value(n, g, lang) for g in some) / len(some)
                    break
        best = max(sums.values())
        first = next(lang for lang in sums if sums[lang] == best)
        return first, 1 / sum(math.exp(s - best) for s in sums.values())

    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify_language(docs).collect()}
    want = {d: scored(t) for d, t, _ in rows}
    assert {d: x for d, (x, _) in got.items()} == {d: x for d, (x, _) in want.items()} and max(abs(got[d][1] - want[d][1]) for d in got) < 1e-6
    # No learnt letter: all languages are equal, and the first in the alphabet wins. Repeated rows are scored alike.
    assert got[901] == ("aa", 1 / 3) or abs(got[901][1] - 1 / 3) < 1e-9
    twice = identify_language(docs.unionByName(docs.filter("lang is null"))).filter("doc_id = 904").collect()
    assert len(twice) == 2 and twice[0] == twice[1]
