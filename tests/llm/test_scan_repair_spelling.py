import hashlib
import math
import random
import re
import statistics
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import repair as repair_module
from tidewright.llm import secret_scan, spelling
from tidewright.llm.queries import damaged, mistyped, op11_secret_scan
from tidewright.llm.repair import repair, repair_conversations, repaired_digests
from tidewright.llm.secret_scan import battery, encoding_of, find_secrets
from tidewright.llm.spelling import count_words, near_words, spelling_groups

SF = "/root/testdata/sf0.001"


# ---- secrets

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def secret_texts():
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("eeeeettttaaaooiinnsshhrrddlucmfwygpbvk") for _ in range(rng.randint(2, 24))) for _ in range(n))
    key = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    planted = {100: key("0123456789abcdef", 40), 101: key(base64, 44), 102: key(base64, 86), 103: key(base64[:62], 60)}
    texts = {i: prose(150) for i in range(60)}
    texts |= {i: f"é {prose(5)} {s} {prose(5)}" for i, s in planted.items()}
    texts |= {
        200: None, 201: "", 202: "secret=token:abcdefghijklmnop", 203: 'PassWord"  =  "abc.DEF-ghi_jkl+/=\' AKIA' + "Q" * 14 + "AKIA12", 204: "é" * 50 + "AKIA" + "Z" * 13 + " AKIA" + "1" * 13 + "é",
        205: "deadbeefdeadbee deadbeefdeadbeefA 0123456789abcdef" * 3, 206: "paſſword=abcdefghijklmnopq toKen=abcdefghijklmnopq", 207: "=" * 80 + "-" * 60 + "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
        208: "word " * 100_000 + planted[101], 209: "api_key:'aaaaaaaaaaa' apikey:aaaaaaaaaaaa token token=secret:bbbbbbbbbbbbbb",
    }
    return texts, planted


@pytest.fixture(scope="module")
def secrets(spark):
    texts, planted = secret_texts()
    rows = [(i, t, "kind", [1]) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kind string, base array<int>").repartition(3)
    return texts, planted, {r["doc_id"]: r for r in find_secrets(docs).collect()}


def test_secret_patterns_equal_plain_patterns(secrets):
    texts, _, found = secrets
    assert set(found) == set(texts)
    for i, text in texts.items():
        assert [tuple(x) for x in found[i]["base"]] == plain_base(text or ""), i
        assert all(x in found[i]["spans"] for x in found[i]["base"])
        assert found[i]["spans"] == sorted(found[i]["spans"])


def test_secret_battery_finds_random_keys_and_leaves_prose(secrets):
    texts, planted, found = secrets
    more = {i: [texts[i][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == 3] for i, r in found.items()}
    for i in (101, 102, 103, 208):
        assert any(planted.get(i, planted[101]).strip("+/").startswith(x[:10]) or x in texts[i] for x in more[i]), i
    assert not any(more[i] for i in range(60)) and not more[207] and not more[200] and not more[201]


def test_secret_battery_keeps_its_level_on_random_strings():
    rng = np.random.default_rng(5)
    for k, n in ((16, 32), (64, 40), (64, 400), (62, 22)):
        ps = [battery(rng.integers(0, k, n), k) for _ in range(2000)]
        assert sum(p < 0.001 for p in ps) <= 25 and 0.2 < statistics.median(ps) < 0.8
    assert battery(np.arange(62), 62) < 0.001 and battery(np.zeros(40, dtype=int), 62) < 1e-6


def test_secret_equal_pairs_are_the_chi_squared_statistic_with_exact_shares():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 16, 50)
    counts = np.bincount(x, minlength=16)
    assert math.isclose(((counts - 50 / 16) ** 2 / (50 / 16)).sum(), 16 / 50 * (2 * secret_scan.equal_pairs(x, 16) + 50) - 50)
    shares = np.array([0.5, 0.3, 0.2])
    table, all_of = secret_scan.collision_table(shares), {}
    for word in product(range(3), repeat=7):
        c = secret_scan.equal_pairs(np.array(word), 3)
        all_of[c] = all_of.get(c, 0) + math.prod(shares[list(word)])
    for c in range(22):
        assert math.isclose(table[7, c], sum(p for k, p in all_of.items() if k <= c), abs_tol=1e-12)
    assert math.isclose(secret_scan.fisher([0.3, 0.2, 0.9]), math.exp(-(h := -math.log(0.3 * 0.2 * 0.9))) * (1 + h + h * h / 2))


def test_secret_false_finds_stay_below_their_rate(spark):
    """Prose of 16 to 80 letters a word: none or next to none pass for keys, whatever their number."""
    rng = random.Random(11)
    letters = "eeeeeeeettttttaaaaaoooooiiiiinnnnnsssshhhhrrrrddllucmfwygpbvk"
    rows = [(i, " ".join("".join(rng.choices(letters, k=rng.randint(16, 80))) for _ in range(60))) for i in range(200)]
    found = find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(len(r["spans"]) for r in found) <= 3


def test_secret_encodings():
    named = lambda s: secret_scan.ENCODINGS[encoding_of(np.frombuffer(s.encode(), dtype=np.uint8))][0]
    assert [named(s) for s in ("019", "0af", "0AF", "xyz", "A2Z7", "a9z", "Aa0", "a+B/", "a-B_", "a+-")] == ["decimal", "hex", "HEX", "letters", "base32", "base36", "base62", "base64", "base64url", "mixed"]


def test_secret_scan_of_nothing_and_of_repeated_rows(spark):
    assert find_secrets(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    rows = find_secrets(spark.createDataFrame([(None, "token=abcdefghijklmnop"), (1, "x"), (1, "x")], "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, len(r["base"])) for r in rows) == [(0, 1), (1, 0), (1, 0)]


def test_secret_query_lists_spans(spark):
    rows = op11_secret_scan(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        base = plain_base(texts[r["doc_id"]])
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert set(filter(None, listed.split(","))) <= set(filter(None, r["spans"].split(",")))


# ---- conversations


def plain_repair(rows):
    """All the contract says, by a forward program over (cost, audit) that carries whole strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        faults.append(1 if not stripped else 2 if (role, text) in seen else 3 if stripped[-1] not in ".!?" else 0)
        seen.add((role, text))
    ok = re.compile("(s?(ua)+)?")
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(states):
        states = dict(states)
        for _ in range(2):
            for place, (cost, audit) in list(states.items()):
                for role in "ua":
                    if (place, role) in steps:
                        best = (cost + 3, audit + "I")
                        to = steps[place, role]
                        states[to] = min(states.get(to, (math.inf, "")), best)
        return states

    states = {"": (0, "")}
    for (_, role, _), fault in zip(rows, faults, strict=True):
        after = {}
        for place, (cost, audit) in inserted(states).items():
            options = [(place, cost + 4, "D")]
            if fault in (0, 3):
                extra = 3 if fault == 3 else 0
                options += [(steps[place, role[:1]], cost + extra, "K")] if (place, role[:1]) in steps else []
                options += [(steps[place, r], cost + 3 + extra, "R") for r in "ua" if (place, r) in steps]
            for to, c, e in options:
                after[to] = min(after.get(to, (math.inf, "")), (c, audit + e))
        states = after
    cost, audit = min(v for k, v in inserted(states).items() if k in ("", "a"))
    lines, at, place = [], 0, ""
    for e in audit:
        if e == "D":
            at += 1
            continue
        say = {"": "user", "s": "user", "u": "assistant", "a": "user"}[place]
        role, text = (rows[at][1] if e == "K" else say, rows[at][2]) if e != "I" else (say, "")
        at += e != "I"
        place = role[:1]
        lines.append(f"{role}:{text}")
    assert ok.fullmatch("".join(x[:1] for x in lines))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def conversations(seed, n):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", "u", "User"], ["One.", "two", " three! \n", "", " \t", "Four?", "é", "five "]
    return [(c, rng.choice([None, *range(9)]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts)) for c in range(n) for _ in range(rng.randint(1, 14))]


def repaired_by_spark(spark, rows, batch=None):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, audit string, place int").repartition(5)
    reports, out = repair(df)
    joined = reports.join(repaired_digests(out).withColumnRenamed("conv_id", "c"), F.col("c").eqNullSafe(F.col("conv_id")), "left")
    return {r["conv_id"]: (*(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")), r["repaired_sha256"] or hashlib.sha256(b"").hexdigest()) for r in joined.collect()}


def test_repair_equals_plain_program(spark):
    rows = conversations(1, 400)
    got = repaired_by_spark(spark, rows)
    for c in {r[0] for r in rows}:
        assert got[c] == plain_repair([r[1:] for r in rows if r[0] == c]), c


def test_repair_is_cheapest_by_brute_force():
    """Against every edit string of up to three rows with up to four inserts."""
    costs = {"K": 0, "R": 3, "D": 4, "I": 3}
    for roles in product("suax", repeat=3):
        want = (math.inf, "")
        for edits in product(*[["D", "K", "R"]] * 3):
            for inserts in product(range(3), repeat=4):
                audit = "".join("I" * inserts[i] + edits[i] for i in range(3)) + "I" * inserts[3]
                for fill in product("ua", repeat=sum(x in "RI" for x in audit)):
                    fill, kept = iter(fill), iter(roles)
                    out = ""
                    for e in audit:
                        role = next(kept) if e != "I" else ""
                        out += role if e == "K" else next(fill) if e in "RI" else ""
                    if re.fullmatch("(s?(ua)+)?", out):
                        want = min(want, (sum(costs[e] for e in audit), audit))
        state = repair_module._Backward()
        for i, r in reversed(list(enumerate(roles))):
            state.add(i, "suax".index(r))
        report = state.finish()
        assert (report[5], report[6]) == want, roles


def test_repair_spills_and_crosses_batches(spark, monkeypatch):
    rng = random.Random(4)
    roles = [rng.choice(["user", "assistant", "system"]) for _ in range(3000)]
    state, small = repair_module._Backward(), repair_module._Backward()
    for i in reversed(range(3000)):
        state.add(i, "sua".index(roles[i][0]))
    monkeypatch.setattr(repair_module, "SPILL_ROWS", 100)
    for i in reversed(range(3000)):
        small.add(i, "sua".index(roles[i][0]))
    assert small.n_spilled == 30 and state.finish() == small.finish()
    rows = [(7, i, r, f"{i}.") for i, r in enumerate(roles)]
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = repaired_by_spark(spark, [*rows, (8, 1, "user", "a."), (None, 1, "user", "b."), (None, 2, "assistant", "c.")])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert got[7] == plain_repair([r[1:] for r in rows]) and got[8][6] == "KI" and got[None][6] == "KK"


def test_repair_of_odd_rows(spark):
    assert repair_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
    rows = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (2, None, "user", "x" * 3_000_000 + ".")], "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in repair_conversations(rows).collect()}
    assert (got[1]["audit"], got[1]["blank"], got[1]["gaps"]) == ("DD", 2, 0) and (got[2]["audit"], got[2]["cost"]) == ("KI", 3)


def test_damage_of_the_query(spark):
    rows = [(c, t, "assistant", "a. b! c?") for c in range(40) for t in [None, *range(5)]]
    got = {}
    for r in damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for c, t, role, text in rows:
        h = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        want = {0: [], 1: [(role, "")], 2: [(role, "a b c")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(h, [(role, text)])
        assert got.get((c, t), []) == want


# ---- spelling


def one_edit_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if one_edit_apart(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w in counts}


def vocabulary(seed, n):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice("abcdeéÿÀß") for _ in range(rng.randint(3, 7))) if not words or rng.random() < 0.3 else rng.choice(sorted(words))
        i = rng.randrange(len(w))
        words.add(rng.choice([w, w[:i] + w[i + 1 :] or "a", w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1 :], "".join(rng.sample(w, len(w)))]))
    return {w: int(2 ** rng.uniform(0, 8)) for w in sorted(words)}


@pytest.mark.parametrize("cell, block, leaf, sample", [(2000, 8000, 48, 100_000), (20, 30, 4, 100_000), (20, 5, 3, 150)])
def test_spelling_groups_equal_brute_force(spark, monkeypatch, cell, block, leaf, sample):
    for name, value in (("CELL", cell), ("BLOCK", block), ("LEAF", leaf), ("SAMPLE", sample)):
        monkeypatch.setattr(spelling, name, value)
    counts = vocabulary(7, 500)
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n bigint, cell string").repartition(3)
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling_groups(df).collect()}
    assert got == plain_groups(counts)


def test_spelling_boxes_prune_and_lose_nothing():
    words = [w for w in vocabulary(9, 3000) if len(w) == 6]
    codes = spelling._codes(words, 6)
    vectors = spelling.letter_counts(codes)
    want = {(i, j) for i in range(len(words)) for j in np.flatnonzero(np.abs(vectors - vectors[i]).sum(axis=1) <= 2)}
    got = {(int(i), int(j)) for a, b in spelling.LeafTree(vectors).search(vectors, 2) for i, j in zip(a, b, strict=True)}
    assert got == want
    tree = spelling.UpperTree(vectors, 0.05 * len(vectors) / spelling.CELL, 1)
    own = dict(zip(*tree.visits(vectors, 0), strict=True))
    rows, cells = tree.visits(vectors, 2)
    seen = {(int(r), int(c)) for r, c in zip(rows, cells, strict=True)}
    assert all((i, own[j]) in seen for i, j in want)


def test_words_are_counted_and_changed(spark):
    texts = [(1, "Aé aé AÉ aÉ x×÷y"), (2, None), (None, "Aé"), (3, "")]
    docs = spark.createDataFrame([(*t, "w") for t in texts], "doc_id bigint, text string, word string")
    got = {r["word"]: r["n"] for r in count_words(docs).collect()}
    assert got == {"aé": 3, "aÉ": 2, "x×÷y": 1}
    changed = {r["word"]: r["n"] for r in count_words(docs, change=lambda i: lambda w: w[:1] if i == 1 else "").collect()}
    assert changed == {"a": 4, "x": 1}
    word = next(w for w in (f"word{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)) if zlib.crc32(f"5:{w}".encode()) % 97 == 0)
    at = zlib.crc32(f"5:{word}".encode()) % len(word)
    assert mistyped(5)(word) == word[:at] + word[at + 1 :] and mistyped(5)("abc") == "abc"


def test_spelling_of_odd_tables(spark):
    assert spelling_groups(spark.createDataFrame([], "word string, n bigint")).count() == 0
    got = spelling_groups(spark.createDataFrame([("a", 1), ("a", 2), ("", 4), (None, 1), ("b", None), ("ab", 9)], "word string, n bigint")).collect()
    assert sorted((r["word"], r["n"], r["form"]) for r in got) == [("a", 3, "ab"), ("ab", 9, None)]
    assert near_words(spark.createDataFrame([("x" * 40_000, 1), ("x" * 40_001, 1)], "word string, n bigint")).count() == 2
