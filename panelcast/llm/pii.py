"""Personal data: exact base patterns, extended by a semi-Markov conditional random field.

Base spans come from four fixed patterns (e-mail, IP address, card number,
phone number) with their checks, leftmost and non-overlapping per kind. The
model proposes further spans. It works on *regions*, runs of words that hold a
digit or an ``@`` or stand behind a key name (``key = ...``). A word has pieces, cut
behind ``= : & ; " '`` and brackets inside it. A segment is one piece, or up to ``MAX_WORDS`` words, of the first one from its
start or last cut on and of the last one to its end or first cut, trimmed to letters,
digits and brackets; it is one candidate entity, and features describe the whole
span (shape, lengths, checks, what stands before and behind), those of a span over ``LONGEST_SPAN`` characters
its two ends and length. Dynamic programming over a region
chooses boundaries and kinds jointly: single pieces may stay outside, entities
have a bounded number of words, so the work is linear in the region.

Training maximizes the segmentations' log-likelihood on regions of a bounded
sample of documents (``sample_docs``, chosen by hash; the only sampled thing),
with the base spans and assigned secrets (``key = ...``) as gold. Each of a
few shards trains on its own regions and the weights are averaged. Decoding
covers every document. Model spans that overlap a base span are dropped.

Edge cases: NULL and empty texts have no spans. Spans count code points, end
exclusive. Very long digit runs are scanned in linear time. Rows with a NULL
or repeated id are each treated by their own text. Without training regions the
model proposes nothing. Other columns pass through ``redact`` unchanged.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import SLICE, map_arrow, map_slices

#: The base kinds in their order of listing, and their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

KINDS = (*BASE_KINDS, "secret")
KEYED = re.compile(r"(?i)(?<![A-Za-z0-9])(?:token|key|secret|password|passwd|pwd)[\"']?\s{0,4}[=:]\s{0,4}[\"']?")
SECRET = re.compile(KEYED.pattern + r"([A-Za-z0-9+/_-]{16,})")

MAX_WORDS = 6
BUCKETS = 4096
MARKED = re.compile(r"(?<![^ \t-\r])[^ \t-\r0-9@]*+[0-9@][^ \t-\r]*")
SPACES = " \t\n\v\f\r"
WORD_END = re.compile(r"[^ \t-\r]*")
#: A cut is behind these, between a letter or digit and the next character that is none of them.
CUT = re.compile(r"(?<=[A-Za-z0-9])[=:&;\"'()\[\]{}<>]++(?=[^ \t-\r])")
LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+(")
RIGHT = (LEFT | {")"}) - {"+", "("}
#: Characters of a span that features look at; of a longer one, half at each end.
LONGEST_SPAN = 256


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and dotted domain, found from each ``@`` outwards."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def octets_fit(address: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in address.split(".")))


def digits_of(span: str) -> str:
    return "".join([c for c in span if "0" <= c <= "9"])


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end), by start and then kind as listed."""
    if not text:
        return []
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if octets_fit(m[0])]
        out += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- regions and features -------------------------------------------------

Region = list[tuple[int, int]]


def regions(text: str | None) -> list[Region]:
    """Runs of neighbouring words with a digit or an ``@`` or behind a key name, as bounds of their pieces.

    Pieces of one word touch."""
    text = text or ""
    found = [m.span() for m in MARKED.finditer(text)]
    done = 0
    for m in KEYED.finditer(text):
        a = m.end()
        if a < max(done, 1) or a == len(text) or text[a] in SPACES:
            continue
        done = WORD_END.match(text, a).end()
        while a and text[a - 1] not in SPACES:
            a -= 1
        found.append((a, done))
    out: list[Region] = []
    end = -1
    for a, b in sorted(set(found)):
        if not out or text[end:a].strip():
            out.append([])
        cuts = [a, *(m.end() for m in CUT.finditer(text, a, b) if m.end() < b), b]
        out[-1] += zip(cuts, cuts[1:])
        end = b
    return out


def edges(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The piece without marks around it; None if nothing is left."""
    while start < end and text[start] not in LEFT:
        start += 1
    stop = end
    while stop > start and text[stop - 1] not in RIGHT:
        stop -= 1
    return (start, stop) if start < stop else None


def features(text: str, start: int, end: int, words: int) -> list[int]:
    """Hashed whole-span features."""
    long = end - start > LONGEST_SPAN
    s = text[start:start + LONGEST_SPAN // 2] + text[end - LONGEST_SPAN // 2:end] if long else text[start:end]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "9", s)))[:40]
    digits, letters = digits_of(s), sum(c.isalpha() for c in s)
    before = text[max(0, start - 24):start].split()
    keyed = any(m.end() == start for m in KEYED.finditer(text, max(0, start - 24), start))
    raw = [
        "bias", "shape=" + shape, "kinds=" + "".join(sorted(set(shape))), f"digits={min(len(digits), 20)}",
        f"letters={min(letters, 40) // 4}", f"length={min(len(s), 64) // 4}", f"words={words}", "first=" + s[0], "last=" + s[-1],
        "before=" + text[max(0, start - 1):start], "behind=" + text[end:end + 1],
        "word1=" + (before[-1].lower() if before else ""), "word2=" + (before[-2].lower() if len(before) > 1 else ""),
        f"ip={bool(IP.fullmatch(s)) and octets_fit(s)}", f"dotted={s.count('.')}",
        f"card={bool(CARD.fullmatch(s)) and 12 <= len(digits) <= 19 and luhn(digits)}",
        f"phone={bool(PHONE.fullmatch(s)) and 9 <= len(digits) <= 15}", f"mail={list(emails(s)) == [(0, len(s))]}",
        f"keyed={keyed}", f"run={keyed and len(s) >= 16 and not re.search('[^A-Za-z0-9+/_-]', s)}",
        f"hex={len(s) >= 16 and not re.search('[^0-9a-fA-F]', s)}",
    ]
    return [zlib.crc32(r.encode()) % BUCKETS for r in raw]


def candidates(text: str, region: Region) -> list[list[tuple[int, tuple[int, int], int]]]:
    """Per end position (pieces) the candidate entities that end there: (first piece, span, words)."""
    bare = [edges(text, *piece) for piece in region]
    heads = [k for k in range(len(region)) if not k or region[k - 1][1] < region[k][0]] + [len(region)]
    out = [[] for _ in range(len(region) + 1)]
    starts: list[list[int]] = []  # of each word: its start and its last cut
    for word, (head, behind) in enumerate(zip(heads, heads[1:])):
        starts.append(sorted({head, behind - 1}))
        for j in range(head + 1, behind + 1):
            at = {j - 1}
            if j in (head + 1, behind):
                at |= {i for own in starts[max(0, word + 1 - MAX_WORDS):] for i in own if i < j}
            for i in sorted(at):
                if bare[i] and bare[j - 1]:
                    out[j].append((i, (bare[i][0], bare[j - 1][1]), word + 1 - _word(heads, i)))
    return out


def _word(heads: list[int], piece: int) -> int:
    return bisect_right(heads, piece) - 1


def segments(text: str, region: Region) -> list[list[tuple[int, tuple[int, int], list[int]]]]:
    """``candidates`` with their features: (first piece, span, features)."""
    return [[(i, span, features(text, *span, words)) for i, span, words in row] for row in candidates(text, region)]


# --- the model -----------------------------------------------------------------


class Model:
    """weights: (BUCKETS, kinds); moves: previous label (0: outside or start) to kind. Outside scores 0."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((BUCKETS, len(KINDS))) if weights is None else weights
        self.moves = np.zeros((len(KINDS) + 1, len(KINDS))) if moves is None else moves

    def decode(self, text: str, region: Region) -> list[tuple[str, int, int]]:
        """The best segmentation's entities; outside wins ties."""
        ends = segments(text, region)
        n, labels = len(region), len(KINDS) + 1
        best = np.full((n + 1, labels), -np.inf)
        best[0, 0] = 0.0
        back: list[list] = [[None] * labels for _ in range(n + 1)]
        for j in range(1, n + 1):
            prev = int(best[j - 1].argmax())
            best[j, 0], back[j][0] = best[j - 1, prev], (j - 1, prev, None)
            for i, span, feats in ends[j]:
                score = self.weights[feats].sum(axis=0)
                into = best[i][:, None] + self.moves
                prevs = into.argmax(axis=0)
                for k in range(len(KINDS)):
                    value = into[prevs[k], k] + score[k]
                    if value > best[j, k + 1] + 1e-12:
                        best[j, k + 1], back[j][k + 1] = value, (i, int(prevs[k]), span)
        out, j, label = [], n, int(best[n].argmax())
        while j:
            i, prev, span = back[j][label]
            if label:
                out.append((KINDS[label - 1], *span))
            j, label = i, prev
        return out[::-1]

    def gradient_step(self, ends: list, gold: dict[tuple[int, int], int], rate: float, seen: np.ndarray) -> None:
        """One step on the log-likelihood of a region. ``gold``: (first word, end) to kind."""
        n, labels = len(ends) - 1, len(KINDS) + 1
        scores = [[self.weights[f].sum(axis=0) for _, _, f in row] for row in ends]
        fwd = np.full((n + 1, labels), -np.inf)
        fwd[0, 0] = 0.0
        for j in range(1, n + 1):
            fwd[j, 0] = np.logaddexp.reduce(fwd[j - 1])
            for (i, _, _), s in zip(ends[j], scores[j]):
                fwd[j, 1:] = np.logaddexp(fwd[j, 1:], np.logaddexp.reduce(fwd[i][:, None] + self.moves, axis=0) + s)
        bwd = np.full((n + 1, labels), -np.inf)
        bwd[n] = 0.0
        starts: list[list] = [[] for _ in range(n + 1)]
        for j in range(1, n + 1):
            for (i, _, f), s in zip(ends[j], scores[j]):
                starts[i].append((j, f, s))
        for i in range(n - 1, -1, -1):
            bwd[i] = bwd[i + 1, 0]
            for j, _, s in starts[i]:
                bwd[i] = np.logaddexp(bwd[i], np.logaddexp.reduce(self.moves + (s + bwd[j, 1:])[None, :], axis=1))
        total = np.logaddexp.reduce(fwd[n])
        move_step = np.zeros_like(self.moves)
        steps = []
        for i in range(n):
            for j, feats, s in starts[i]:
                joint = np.exp(fwd[i][:, None] + self.moves + (s + bwd[j, 1:])[None, :] - total)
                steps.append((feats, -joint.sum(axis=0)))
                move_step -= joint
                if (i, j) in gold:
                    steps[-1][1][gold[i, j]] += 1.0
        last = {b: k + 1 for (_, b), k in gold.items()}
        for (a, _), k in gold.items():
            move_step[last.get(a, 0), k] += 1.0
        for feats, step in steps:
            seen[feats] += step ** 2
            self.weights[feats] += rate * step / np.sqrt(1e-6 + seen[feats])
        self.moves += 0.1 * rate * move_step


def gold_of(text: str, region: Region) -> dict[tuple[int, int], int] | None:
    """Gold segments of a region; None if a gold span is no candidate."""
    lo, hi = region[0][0], region[-1][1]
    spans = [s for s in base_spans(text[max(0, lo - 64):hi + 64])]
    shift = max(0, lo - 64)
    spans = [(k, a + shift, b + shift) for k, a, b in spans if lo <= a + shift and b + shift <= hi]
    spans += [("secret", *m.span(1)) for m in SECRET.finditer(text, max(0, lo - 64), hi) if m.start(1) >= lo and m.end(1) <= hi]
    offered = {(i, j): span for j, row in enumerate(candidates(text, region)) for i, span, _ in row}
    gold, used = {}, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        i = next((k for k, w in enumerate(region) if w[0] <= a < w[1]), None)
        j = next((k + 1 for k, w in enumerate(region) if w[0] < b <= w[1]), None)
        if i is None or j is None or i < used:
            continue
        if offered.get((i, j)) != (a, b):
            return None
        gold[i, j] = KINDS.index(kind)
        used = j
    return gold


def train(docs: DataFrame, *, sample_docs: int = 4000, shards: int = 4, epochs: int = 4, rate: float = 0.3) -> Model:
    """Averages the models of ``shards`` parts of a sample of about ``sample_docs`` documents with marked words."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.col("text").rlike("[0-9@]"))
    many = source.count()
    million = 1_000_000
    chosen = source.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(million))).where(
        F.col("h") < max(1, sample_docs * million // max(many, 1)))

    def make():
        def of_slice(cols):
            """A region as its stretch of text, up to 64 code points around it."""
            out = {"h": [], "part": [], "bounds": []}
            for h, text in zip(cols["h"], cols["text"]):
                for region in regions(text):
                    if len(region) <= 4 * MAX_WORDS and region[-1][1] - region[0][0] < 8192:
                        lo = max(0, region[0][0] - 64)
                        out["h"].append(h)
                        out["part"].append(text[lo:region[-1][1] + 64])
                        out["bounds"].append([x - lo for w in region for x in w])
            return out

        return of_slice

    found = map_slices(chosen.select("h", "text"), make, "h long, part string, bounds array<int>")
    dealt = found.repartition(shards, "h").sortWithinPartitions("h", "part", "bounds")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = []
        for batch in batches:
            for part, bounds in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                region = list(zip(bounds[::2], bounds[1::2]))
                gold = gold_of(part, region)
                if gold is not None:
                    ready.append((segments(part, region), gold))
        if ready:
            model, seen = Model(), np.zeros((BUCKETS, len(KINDS)))
            for _ in range(epochs):
                for ends, gold in ready:
                    model.gradient_step(ends, gold, rate, seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.moves.tobytes()], pa.binary()),
                 pa.array([len(ready)], pa.int64())], names=["weights", "moves", "n"])

    parts = map_arrow(dealt, learn, "weights binary, moves binary, n long").collect()  # one row a shard
    total = sum(p.n for p in parts)
    if not total:
        return Model()
    weights = sum(np.frombuffer(p.weights).reshape(BUCKETS, -1) * p.n for p in sorted(parts, key=lambda p: p.weights)) / total
    moves = sum(np.frombuffer(p.moves).reshape(-1, len(KINDS)) * p.n for p in sorted(parts, key=lambda p: p.weights)) / total
    return Model(weights, moves)


def all_spans(text: str | None, model: Model) -> tuple[list, list]:
    """(base spans, base and model spans), each by start and then kind."""
    base = base_spans(text)
    starts = [x for _, x, _ in base]  # base spans come by start
    furthest = list(accumulate((y for _, _, y in base), max))
    added = []
    for region in regions(text):
        for kind, a, b in model.decode(text, region):
            before = bisect_left(starts, b)  # spans that start before b; one of them overlaps if any ends after a
            if not before or furthest[before - 1] <= a:
                added.append((kind, a, b))
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if added else base


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, base array<struct<kind, start, end>>, spans`` (all) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.moves))
    span = "array<struct<kind:string,start:long,end:long>>"

    def make():
        own = Model(*shared.value)

        def of_slice(cols):
            found = [all_spans(t, own) for t in cols["text"]]
            as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
            return {"doc_id": cols["doc_id"], "base": [as_rows(b) for b, _ in found], "spans": [as_rows(s) for _, s in found]}

        return of_slice

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                      make, f"doc_id long, base {span}, spans {span}")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each (joint) span replaced by its first kind in angle brackets."""
    out, done, until = [], 0, -1
    for kind, a, b in spans:
        if a < until:
            until = max(until, b)
            done = max(done, b)
            continue
        out += [text[done:a], f"<{kind.upper()}>"]
        done = until = b
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns, with personal data masked in ``text`` and ``n_chars`` (if there) set to the new length."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.moves))
    names = docs.columns
    at_text, at_chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = list(part.columns)
                old = part.column(at_text).to_pylist()
                new = [masked(t, all_spans(t, own)[1]) if t else t for t in old]
                if new != old:
                    columns[at_text] = pa.array(new, part.schema.field(at_text).type)
                    if at_chars is not None:
                        chars = part.column(at_chars).to_pylist()
                        columns[at_chars] = pa.array([len(n) if n != o else c for n, o, c in zip(new, old, chars)],
                                                     part.schema.field(at_chars).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return map_arrow(docs, run, docs.schema)
