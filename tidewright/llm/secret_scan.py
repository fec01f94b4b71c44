"""Secrets in texts: patterns, and strings that a battery of randomness tests takes for keys under a false-discovery rate by length."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import written
from tidewright.llm.words import blocks

#: The shortest string that is tested, the share of false finds among the strings found, and the level at which the battery rejects randomness.
LEAST, FALSE_RATE, REJECT = 16, 0.01, 0.001
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A run of the character class is maximal, so the least length can stand in the pattern; for _ASSIGN it can't, as a match that fails consumes text.
_ACCESS, _HEX = re.compile("AKIA[A-Z0-9]{14,}"), re.compile("[0-9a-f]{16,}")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from the smallest on; a string is taken to be in the first that has all its symbols.
ENCODINGS = (
    ("decimal", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("letters", _LOWER), ("LETTERS", _UPPER), ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _LOWER), ("BASE36", _DIGITS + _UPPER), ("base62", _UPPER + _LOWER + _DIGITS), ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"), ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
_PLACES = []
for _, _symbols in ENCODINGS:
    _PLACES.append(np.full(256, -1, dtype=np.int64))
    _PLACES[-1][np.frombuffer(_symbols.encode(), dtype=np.uint8)] = np.arange(len(_symbols))
_IN_RUN = _PLACES[-1] >= 0
#: p-values of the false-discovery control are kept as steps of a twentieth of a decimal, down to 10 ** -50.
STEPS_A_DECIMAL, LAST_STEP = 20, 1000
#: Symbols for which a document counts at most in the frequencies of prose: its shares all count, but one long or odd text doesn't set them.
VOICE = 10_000
#: Symbols up to which the number of equal pairs has an exact table, and the largest number in it; longer strings are taken in such parts.
CHUNK, MOST_PAIRS = 64, 500


def encoding_of(symbols: np.ndarray) -> int:
    """Number of the first alphabet with all the bytes."""
    return next(i for i, places in enumerate(_PLACES) if (places[symbols] >= 0).all())


def normal_tail(z: float) -> float:
    """P(Z > z) of a standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def collision_table(shares: np.ndarray) -> np.ndarray:
    """P(at most c equal pairs among n independent symbols with these shares), exactly, at [n, c] for n up to CHUNK; beyond MOST_PAIRS it is taken as 1.

    The number of equal pairs is the chi-squared statistic of uniformity in other units: X^2 = (k / n)(2 C + n) - n. Symbol by symbol, the ways to give j of n places to it.
    """
    ways = np.zeros((CHUNK + 1, MOST_PAIRS + 1))
    ways[0, 0] = 1.0
    for q in shares:
        after, term = ways.copy(), 1.0
        for j in range(1, CHUNK + 1):
            term *= q / j
            pairs = j * (j - 1) // 2
            if pairs > MOST_PAIRS or term < 1e-300:
                break
            after[j:, pairs:] += term * ways[:-j, : MOST_PAIRS + 1 - pairs]
        ways = after
    n = np.cumprod(np.concatenate([[1.0], np.arange(1, CHUNK + 1)]))
    return np.minimum(np.cumsum(ways * n[:, None], axis=1), 1.0)


@lru_cache
def _even(k: int) -> np.ndarray:
    return collision_table(np.full(k, 1 / k))


def equal_pairs(places: np.ndarray, k: int) -> int:
    counts = np.bincount(places, minlength=k)
    return int((counts * (counts - 1)).sum() // 2)


def chunked(places: np.ndarray) -> list[np.ndarray]:
    """A string in parts of like length, at most CHUNK symbols each."""
    return np.array_split(places, -(-len(places) // CHUNK))


def uneven(places: np.ndarray, k: int) -> float:
    """p of chi-squared for uniformity: exact for short strings, by the cube-root transformation of a gamma variable for long ones."""
    c, n = equal_pairs(places, k), len(places)
    if n <= CHUNK:
        return 1.0 if c == 0 else 1.0 if c > MOST_PAIRS and _even(k)[n, -1] >= 1 else max(1 - float(_even(k)[n, min(c - 1, MOST_PAIRS)]), 0.0)
    mean = n * (n - 1) / 2 / k
    shape = mean / (1 - 1 / k)
    return normal_tail((np.cbrt(c / mean) - 1 + 1 / (9 * shape)) * 3 * math.sqrt(shape))


def fisher(ps: list[float]) -> float:
    """p of independent p-values together: the tail of chi-squared with two degrees of freedom for each, in logarithms."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    if half == 0:
        return 1.0
    total, term = 0.0, 0.0
    terms = []
    for i in range(len(ps)):
        terms.append(term)
        term += math.log(half) - math.log(i + 1)
    top = max(terms)
    total = top + math.log(sum(math.exp(t - top) for t in terms)) - half
    return math.exp(total) if total > -700 else 0.0


def battery(places: np.ndarray, k: int) -> float:
    """p that random symbols, as places in an alphabet of k, look as odd, by Fisher's sum of three tests.

    Chi-squared for uniformity (upper side); Wald-Wolfowitz runs of the lower and upper half of the alphabet; correlation of neighbours (both sides).
    """
    n = len(places)
    tests = [uneven(places, k)]
    high = places >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if n0 and n1:
        mean = 1 + 2 * n0 * n1 / n
        variance = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        tests.append(2 * normal_tail(max(abs(runs - mean) - 0.5, 0) / math.sqrt(variance)))
    else:
        tests.append(2.0 ** (1 - n))
    x = places - places.mean()
    spread = float(x @ x)
    serial = float(x[1:] @ x[:-1]) / spread if spread else 1.0
    tests.append(2 * normal_tail(abs(serial + 1 / n) * math.sqrt(n)))
    return fisher(tests)


def prose_step(pairs: list[int], n: int, table: np.ndarray) -> int:
    """Step of the p-value that prose gives as few equal pairs: exact in each part of the string, whose parts are independent."""
    sizes = [n // len(pairs) + (i < n % len(pairs)) for i in range(len(pairs))]
    p = fisher([float(table[m, c]) if c <= MOST_PAIRS else 1.0 for m, c in zip(sizes, pairs, strict=True)])
    return min(LAST_STEP, int(-math.log10(max(p, 1e-60)) * STEPS_A_DECIMAL))


def length_class(n: int) -> int:
    """Half octaves of the length."""
    return int(2 * math.log2(n))


@dataclass(frozen=True)
class Rules:
    """``collision_table`` of each encoding's symbols as the corpus has them, and the least step that counts by (encoding, length class)."""

    tables: list[np.ndarray]
    least: dict[tuple[int, int], int]

    def finds(self, encoding: int, n: int, pairs: list[int], p: float) -> bool:
        least = self.least.get((encoding, length_class(n)))
        return least is not None and p >= REJECT and prose_step(pairs, n, self.tables[encoding]) >= least


def patterns(text: str) -> list[tuple[int, int]]:
    """(start, end) of the assignments in a text whose value has 12 or more characters."""
    low = text.lower()
    return [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 12] if any(k in low for k in _KEYWORDS) else []


_SCANNED = "base array<struct<start:bigint,kind:int,end:bigint>>, tested array<struct<start:bigint,end:bigint,encoding:int,pairs:array<int>,p:double,hash:bigint>>, symbols array<bigint>"


def scan_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, base, tested, symbols) in one reading of the texts: matches of the patterns, strings of LEAST or more symbols with the results of the battery, and, on
    the first row of each block of rows, how often each byte occurs in the runs of the block's documents, none of which counts for more than VOICE. Long strings are found by whole blocks of bytes; patterns of their symbols are looked for in them only."""
    kind = docs.schema[id_col].dataType.simpleString()
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    tested_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.int32()), ("pairs", pa.list_(pa.int32())), ("p", pa.float64()), ("hash", pa.int64())]))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("_id"), batch.column("_text")
            for block in blocks(texts, word_bytes=_IN_RUN):
                base: list[list] = [[] for _ in range(block.n_rows)]
                tested: list[list] = [[] for _ in range(block.n_rows)]
                long = np.flatnonzero(block.ends - block.starts >= LEAST)
                if len(long):
                    begun = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                    for i in long:
                        row, at, end = int(block.row[i]), int(block.starts[i]), int(block.ends[i])
                        place = int(begun[at] - begun[block.offsets[row]])
                        symbols = block.data[at:end]
                        string = symbols.tobytes().decode("ascii")
                        for number, pattern in ((1, _ACCESS), (2, _HEX)):
                            base[row] += [{"start": place + m.start(), "kind": number, "end": place + m.end()} for m in pattern.finditer(string)]
                        body = string.strip("-_+/")
                        if len(body) < LEAST:
                            continue
                        head = string.index(body)
                        symbols = symbols[head : head + len(body)]
                        encoding = encoding_of(symbols)
                        places, k = _PLACES[encoding][symbols], len(ENCODINGS[encoding][1])
                        pairs = [equal_pairs(part, k) for part in chunked(places)]
                        tested[row].append({"start": place + head, "end": place + head + len(body), "encoding": encoding, "pairs": pairs, "p": battery(places, k), "hash": _hash(body)})
                for row in range(block.n_rows):
                    text = texts[block.first_row + row].as_py()
                    if text:
                        base[row] += [{"start": a, "kind": 0, "end": b} for a, b in patterns(text)]
                    base[row].sort(key=lambda x: (x["start"], x["kind"]))
                in_runs = np.zeros(256)
                for row in range(block.n_rows):
                    own = np.bincount(block.data[block.offsets[row] : block.offsets[row + 1]], minlength=256) * _IN_RUN
                    in_runs += own * (min(1.0, VOICE / max(int(own.sum()), 1)))
                counted = [np.rint(in_runs).astype(np.int64).tolist()] + [None] * (block.n_rows - 1)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.first_row, block.n_rows), pa.array(base, base_type), pa.array(tested, tested_type), pa.array(counted, pa.list_(pa.int64()))], ["_id", "base", "tested", "symbols"]
                )

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, {_SCANNED}")


def _hash(string: str) -> int:
    return xxhash.xxh64_intdigest(string) - 2**63


def learn_rules(scanned: DataFrame, false_rate: float = FALSE_RATE) -> Rules:
    """Shares of symbols over all documents, then Benjamini-Hochberg over all distinct strings of an encoding and length class.

    Null hypothesis: the string is prose, drawn with the corpus's own frequencies of the encoding's symbols, by the exact distribution of equal pairs. A short string cannot have a small p-value and has its own
    class, so neither do short strings borrow from long ones nor does their number raise the bar for those. P-values are counted in steps, so what
    reaches the driver is 256 sums and at most LAST_STEP + 1 counts a class.
    """
    found = scanned.filter("symbols is not null").select(F.posexplode("symbols").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(256)
    for r in found:
        counts[r["byte"]] = r["n"]
    tables = []
    for _, symbols in ENCODINGS:
        own = counts[np.frombuffer(symbols.encode(), dtype=np.uint8)]
        tables.append(collision_table((own + 1) / (own.sum() + len(own))))

    def steps(batches):
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            out = [(h, e, length_class(n), prose_step(c, n, tables[e]) if p >= REJECT else -1) for h, e, n, c, p in rows]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.int32()) for c in columns[1:])], ["hash", "encoding", "class", "step"])

    strings = scanned.select(F.explode("tested").alias("t")).select("t.hash", "t.encoding", (F.col("t.end") - F.col("t.start")).alias("n"), "t.pairs", "t.p")
    told = strings.mapInArrow(steps, "hash bigint, encoding int, class int, step int").distinct().groupBy("encoding", "class", "step").count().collect()
    least: dict[tuple[int, int], int] = {}
    classes: dict[tuple[int, int], dict[int, int]] = {}
    for r in told:
        classes.setdefault((r["encoding"], r["class"]), {})[r["step"]] = r["count"]
    for key, by_step in classes.items():
        total, above = sum(by_step.values()), 0
        for step in sorted((s for s in by_step if s >= 0), reverse=True):
            above += by_step[step]
            if total * 10 ** (-step / STEPS_A_DECIMAL) <= false_rate * above:
                least[key] = step
    return Rules(tables, least)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_rate: float = FALSE_RATE) -> DataFrame:
    """One row per row of ``docs``: id, base, spans; both arrays of (start, kind, end), in code points, end exclusive, by start, then kind.

    ``kind`` is a number in KINDS. ``base``: matches of three patterns (the whole match is the span). ``spans`` adds strings ("random") that pass as random symbols of
    their encoding and that prose would hardly give: see ``battery`` and ``learn_rules``. A string that base spans cover is not added again.

    Texts are read once and not shuffled; the strings of LEAST or more symbols, few in prose, are kept as a table. Null and empty texts have no spans. Repeated rows
    are scanned alike, and a string that occurs often is one hypothesis. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    scanned = written(scan_texts(docs, id_col, text_col), "secret-strings")
    rules = learn_rules(scanned, false_rate)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            out = []
            for base, tested in zip(batch.column("base").to_pylist(), batch.column("tested").to_pylist(), strict=True):
                more = [{"start": t["start"], "kind": 3, "end": t["end"]} for t in tested if rules.finds(t["encoding"], t["end"] - t["start"], t["pairs"], t["p"])]
                more = [m for m in more if not any(b["start"] <= m["start"] and m["end"] <= b["end"] for b in base)] if base else more
                out.append(sorted(base + more, key=lambda x: (x["start"], x["kind"])))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("base"), pa.array(out, span_type)], ["_id", "base", "spans"])

    spans = "array<struct<start:bigint,kind:int,end:bigint>>"
    return scanned.select("_id", "base", "tested").mapInArrow(run, f"_id {kind}, base {spans}, spans {spans}").withColumnRenamed("_id", id_col)
