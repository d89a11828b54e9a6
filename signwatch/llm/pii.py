"""Personal data: high-recall generators propose overlapping spans, boosted trees choose among them.

Generators propose every e-mail, address, number and card-like string, with and without country codes, in written-out
forms too, and parts of longer ones. Gradient-boosted trees score each proposal from its format (length, digits,
groups, check sums, separators) and its context (cue words before it, characters around it). A threshold for each
kind, set on proposals kept apart from training so that ``PRECISION`` is reached, selects the spans to redact; of
overlapping ones the best stays.

The trees learn from proposals whose truth is known. Personal data are those that a fixed pattern accepts, the same
values written in forms that no pattern accepts (``rewritten``: '(at)' for '@', national numbers, other grouping) where
they stand, and others that a cue word or check sum confirms. Not personal data are proposals that fail a check, cut a
known one short or stand inside a longer word, and ordinary numbers and phrases in the place of a known one. Proposals
of unknown truth are left out. The thresholds are set on the proposals that overlap no fixed span, as only such ones
can be added; all forms of one value are on the same side of the calibration. The proposals of all documents are used:
equal ones count once, those that no cut tells apart are one row with their number, and Spark adds up the gradients of
each level of a tree by node, feature and cut, of which the driver gets the sums. The spans that the fixed patterns find
stay in any case.

Null texts are empty. Repeated rows are judged alike. Work is per document; proposals are shuffled, texts are not.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signwatch.llm import tables

PRECISION = 0.95
ROUNDS, DEPTH, RATE, BINS = 60, 3, 0.2, 32
#: Steps of a gradient to one, so that sums are exact in any order; and steps of the score, for the thresholds.
EXACT, STEPS = 1 << 20, 1 << 14

KINDS = ("email", "ip", "card", "phone")

#: The patterns of each kind.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*@[A-Za-z0-9._%+@-]*")
_NUMBER_RUN = re.compile(r"[+(]?[0-9][0-9().+\x20/-]*[0-9]")
_WRITTEN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[] ?dot ?[)\]]) ?[A-Za-z0-9-]+)+")
_WRITTEN_DOT = re.compile(r" ?[(\[] ?dot ?[)\]] ?")
#: A number goes on across a separator or two.
_MORE_BEFORE, _MORE_AFTER = re.compile(r"[0-9][ ./()-]{0,2}\Z"), re.compile(r"[ ./()-]{0,2}[0-9]")
_NATIONAL = re.compile(r"\(?[0-9]{1,5}\)?(?:[ ./-]?\(?[0-9]{2,}\)?)+")
#: Dates, ranges of years and long fractions.
_ORDINARY = re.compile(r"(?:19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2} ?[-/ ] ?(?:19|20)[0-9]{2}|[0-9]{1,2}\.[0-9]{5,}")
_PART = re.compile(r"\+?[0-9][0-9.()/-]*[0-9]|\+?\(?[0-9]+\)?(?:[ .-][0-9]+)+")

#: Words that announce a kind.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "@"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "tél", "telefon"),
}
FEATURES = [
    "kind", "length", "digits", "letters", "groups", "longest", "plus", "at", "dots", "blanks", "dashes", "brackets",
    "luhn", "octets", "top_level", "word_before", "word_after", "digit_before", "digit_after", "mark_before", "mark_after",
    "cue", "other_cue", "line",
]


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def octets(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-12:]) <= 255 for p in value.split("."))


def fixed_spans(raw: str) -> list[tuple[int, int, int]]:
    """Kind number, begin and end of what the fixed patterns accept."""
    found = []
    if "@" in raw:
        for run in _EMAIL_RUN.finditer(raw):  # a match only has characters of its run
            found += [(0, *m.span()) for m in EMAIL.finditer(raw, *run.span())]
    # A number has two digits in a row or digits with one separator between; most texts have none.
    for run in _NUMBER_RUN.finditer(raw):
        begin, end = run.span()
        if end - begin < 7:
            continue
        found += [(1, *m.span()) for m in IP.finditer(raw, begin, end) if octets(m[0])]
        for m in CARD.finditer(raw, begin, end):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        for m in PHONE.finditer(raw, begin, end):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, *m.span()))
    return sorted(found)


def proposals(raw: str, fixed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that may be personal data, the fixed ones among them; they overlap."""
    found = set(fixed)
    if "@" in raw:
        for m in _EMAIL_RUN.finditer(raw):
            begin, end = m.span()
            if end - begin >= 6:
                found.add((0, begin, end))
                tail = raw[begin:end].rstrip(".-+%@")
                found.add((0, begin, begin + len(tail)))
    if "(at)" in raw or "[at]" in raw or "( at" in raw or "[ at" in raw:
        for m in _WRITTEN_EMAIL.finditer(raw):
            found.add((0, *m.span()))
            sentence = m[0].split(". ")[0]  # what follows may be the next sentence
            if _WRITTEN_EMAIL.fullmatch(sentence):
                found.add((0, m.start(), m.start() + len(sentence)))
    for run in _NUMBER_RUN.finditer(raw):
        begin, end = run.span()
        if end - begin < 7:
            continue
        spans = {(begin, end)} | {m.span() for m in _PART.finditer(raw, begin, end)}
        for a, b in spans:
            value = raw[a:b]
            n = sum(c.isdigit() for c in value)
            if value.count(".") == 3 and n == len(value) - 3:
                found.add((1, a, b))
            if 12 <= n <= 19:
                found.add((2, a, b))
            if 7 <= n <= 15:
                found.add((3, a, b))
    return sorted(found)


def describe(raw: str, kind: int, begin: int, end: int) -> list[float]:
    """Format and context of a proposal."""
    value = raw[begin:end]
    digits = "".join(c for c in value if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", value)
    before, after = raw[max(0, begin - 1) : begin], raw[end : end + 1]
    context = set(re.findall(r"[\w@-]+", raw[max(0, begin - 40) : begin].lower())[-4:])
    cue = any(w in context for w in CUES[KINDS[kind]])
    other = any(w in context for k, words in CUES.items() if k != KINDS[kind] for w in words)
    last = _WRITTEN_DOT.sub(".", value).rsplit(".", 1)[-1]
    return [
        kind, len(value), len(digits), sum(c.isalpha() for c in value), len(groups), max(map(len, groups), default=0),
        value.startswith("+"), value.count("@"), value.count("."), value.count(" "), value.count("-"),
        value.count("(") + value.count(")"), len(digits) >= 12 and luhn(digits),
        value.count(".") == 3 and all(len(g) <= 3 and int(g) <= 255 for g in groups), last.isalpha() and 2 <= len(last) <= 6,
        before.isalpha(), after.isalpha(), bool(_MORE_BEFORE.search(raw[max(0, begin - 3) : begin])), bool(_MORE_AFTER.match(raw[end : end + 3])),
        bool(before) and not before.isalnum() and not before.isspace(), bool(after) and not after.isalnum() and not after.isspace(),
        cue, other, "\n" in value,
    ]


@dataclass
class Trees:
    """Gradient-boosted trees of one depth: for each node a feature and a cut, for each leaf a value."""

    start: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Trees:
        """Trees of rows that are at hand."""
        edges = [np.unique(np.quantile(x[:, k], LEVELS)) for k in range(x.shape[1])]
        bins, n = binned(x, edges), np.ones(len(y))
        return cls.grown(edges, float(y.mean()), lambda *tree: histogram(bins, y, n, *tree))

    @classmethod
    def grown(cls, edges: list[np.ndarray], share: float, sums: Callable[..., np.ndarray]) -> Trees:
        """Logistic loss, histogram splits, Newton leaves.

        ``sums`` gets the trees so far, features and cuts of the next one, and the level that they end before; it returns
        what ``histogram`` does.
        """
        share = np.clip(share, 1e-6, 1 - 1e-6)
        model = cls(float(np.log(share / (1 - share))))
        for _ in range(ROUNDS):
            features, cuts = np.zeros(2**DEPTH - 1, dtype=np.int64), np.full(2**DEPTH - 1, np.inf)
            for level in range(DEPTH):
                first, width = 2**level - 1, 2**level
                found = sums(model, features, cuts, level)
                best = np.full(width, 1e-6)
                # Gradients and curvatures left and right of the cut; without a cut all is left.
                leaves = np.zeros((2, width, 2))
                leaves[:, :, 0] = found[0].sum(axis=2).T
                for k, e in enumerate(edges):
                    if not len(e):
                        continue
                    left = found[k].cumsum(axis=2)[:, :, : len(e)]
                    right = found[k].sum(axis=2, keepdims=True) - left
                    total = left + right
                    gain = left[:, 0] ** 2 / (left[:, 1] + 1) + right[:, 0] ** 2 / (right[:, 1] + 1) - total[:, 0] ** 2 / (total[:, 1] + 1)
                    at = gain.argmax(axis=1)
                    rows = np.arange(width)
                    better = gain[rows, at] > best
                    best = np.where(better, gain[rows, at], best)
                    where = rows[better]
                    features[first + where], cuts[first + where] = k, at[better]
                    for side, part in enumerate((left, right)):
                        leaves[:, where, side] = part[where, :, at[better]].T
            g, h = leaves.reshape(2, -1)
            model.features.append(features)
            model.cuts.append(cuts)
            model.leaves.append(RATE * g / (h + 1))
        # Cuts between bins become values.
        model.cuts = [
            np.array([edges[k][int(c)] if np.isfinite(c) else c for k, c in zip(features, cuts, strict=True)])
            for features, cuts in zip(model.features, model.cuts, strict=True)
        ]
        return model

    def margins(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            margin += leaves[nodes(x, features, cuts, DEPTH) - (2**DEPTH - 1)]
        return margin

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


#: Shares of the rows below the cuts that are tried.
LEVELS = np.linspace(0, 1, BINS + 1)[1:-1]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """For each value the number of its feature's cuts below it."""
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1).astype(np.uint8)


def nodes(x: np.ndarray, features: np.ndarray, cuts: np.ndarray, level: int) -> np.ndarray:
    """The node of each row before the level."""
    node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(level):
        node = 2 * node + 1 + (x[rows, features[node]] > cuts[node])
    return node


def histogram(bins: np.ndarray, y: np.ndarray, n: np.ndarray, model: Trees, features: np.ndarray, cuts: np.ndarray, level: int) -> np.ndarray:
    """Gradient and curvature by feature, node of the level and bin, of rows that stand for ``n`` equal ones each."""
    p = 1 / (1 + np.exp(-np.clip(model.margins(bins), -40, 40)))
    node = nodes(bins, features, cuts, level) - (2**level - 1)
    out = np.zeros((bins.shape[1], 2**level, 2, BINS))
    for side, values in enumerate((y - p, p * (1 - p))):
        exact = np.rint(n * values * EXACT)
        for k in range(bins.shape[1]):
            out[k, :, side] = np.bincount(node * BINS + bins[:, k], weights=exact, minlength=2**level * BINS).reshape(-1, BINS)
    return out / EXACT


@dataclass
class Model:
    trees: Trees
    #: For each kind the least score that is selected.
    thresholds: list[float]

    def select(self, raw: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
        """The fixed spans, and the spans that the model adds, with their scores."""
        fixed = fixed_spans(raw)
        rest = [s for s in proposals(raw, fixed) if all(s[2] <= f[1] or f[2] <= s[1] for f in fixed)]
        if not rest or not self.trees.leaves:
            return fixed, []
        score = self.trees.scores(np.array([describe(raw, *s) for s in rest], dtype=np.float64))
        added: list[tuple[int, int, int, float]] = []
        for k in np.lexsort((np.arange(len(rest)), -score)):
            kind, begin, end = rest[k]
            if score[k] >= self.thresholds[kind] and all(end <= a[1] or a[2] <= begin for a in added):
                added.append((kind, begin, end, float(score[k])))
        return fixed, sorted(added)


def truth(raw: str, kind: int, begin: int, end: int, row: list[float]) -> int | None:
    """Whether a proposal outside the fixed spans is personal data, as far as its format and cue words tell."""
    value, cue = raw[begin:end], row[FEATURES.index("cue")]
    if raw[max(0, begin - 1) : begin].isalnum() or raw[end : end + 1].isalnum():
        return 0
    if kind == 0:
        if "@" in value or not row[FEATURES.index("top_level")]:
            return 0
        return 1 if cue or _WRITTEN_DOT.search(value) else None
    if kind == 1:
        return None if octets(value) else 0
    if kind == 2:
        if not row[FEATURES.index("luhn")]:
            return 0
        return 1 if cue and row[FEATURES.index("digits")] >= 14 else None
    if _ORDINARY.fullmatch(value):
        return 0
    if cue:
        return 1 if not row[FEATURES.index("digit_after")] and _NATIONAL.fullmatch(value) else None
    return 0 if row[FEATURES.index("other_cue")] else None


def rewritten(kind: int, value: str) -> tuple[list[str], list[str]]:
    """An accepted value in forms that no fixed pattern accepts, and ordinary text for its place."""
    if kind == 0:
        name, domain = value.split("@")
        first = domain.split(".")[0]
        forms = [f"{name} (at) {domain.replace('.', ' (dot) ')}", f"{name}[at]{domain.replace('.', '[dot]')}", f"{name} [at] {domain}", f"{name}(at){domain}"]
        return forms, [f"{name} (at) {first}. The", f"{name} (at) 9.30", f"{name}@{first}"]
    digits = re.sub("[^0-9]", "", value)
    if kind == 2:
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 5) % 10)
        return [mark.join(fours) for mark in "./"] + ["  ".join(fours)], [wrong, "/".join(wrong[k : k + 4] for k in range(0, len(wrong), 4))]
    if kind == 3:
        ordinary = [f"20{digits[-2:]}-0{digits[-3]}-1{digits[-4]}", f"19{digits[-2:]}-20{digits[-4:-2]}", f"{digits[-1]}.{digits[-7:]}"]
        country = re.match(r"\+[0-9]{1,3}[ .-]+(?=[(0-9])", value)
        rest = value[country.end() :] if country else ""
        groups = re.findall("[0-9]+", rest)
        if len(groups) < 2 or not 7 <= sum(map(len, groups)) <= 13:
            return [], ordinary
        zero = groups if groups[0].startswith("0") else ["0" + groups[0], *groups[1:]]
        forms = {rest, value[1:], "-".join(groups), " ".join(groups), ".".join(groups), f"{zero[0]} {''.join(zero[1:])}", f"{zero[0]}/{''.join(zero[1:])}", f"({zero[0]}) {' '.join(zero[1:])}"}
        return sorted(forms), ordinary
    return [], []


#: Characters around a rewritten span that are looked at; more than the context of ``describe``.
AROUND = 100


def _examples(raw: str) -> Iterator[tuple[list[float], int, bool, str, str]]:
    """Features, label, whether the proposal is outside the fixed spans, value, and the value that it comes from."""
    fixed = fixed_spans(raw)
    accepted = set(fixed)
    free = []
    for span in proposals(raw, fixed):
        kind, begin, end = span
        near = [f for f in fixed if begin < f[2] and f[1] < end]
        row = describe(raw, *span)
        if near:
            yield row, int(span in accepted), False, raw[begin:end], raw[near[0][1] : near[0][2]]
        else:
            free.append((span, row, truth(raw, *span, row)))
    sure = [span for span, _, label in free if label == 1]
    for span, row, label in free:
        kind, begin, end = span
        if label is None and any(begin < x[2] and x[1] < end for x in sure):
            label = 0  # cuts a known one short
        if label is not None:
            yield row, label, True, raw[begin:end], raw[begin:end]
    for kind, begin, end in fixed:
        value = raw[begin:end]
        forms, ordinary = rewritten(kind, value)
        before, after = raw[max(0, begin - AROUND) : begin], raw[end : end + AROUND]
        for label, texts in ((1, forms), (0, ordinary)):
            for form in texts:
                changed = before + form + after
                right = (kind, len(before), len(before) + len(form))
                own = fixed_spans(changed)
                near = [
                    s for s in proposals(changed, own)
                    if s[1] < right[2] and right[1] < s[2] and all(s[2] <= f[1] or f[2] <= s[1] for f in own)
                ]
                if label and right not in near:
                    continue
                for span in near:
                    yield describe(changed, *span), int(bool(label) and span == right), True, changed[span[1] : span[2]], value


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proposals of known truth with their features, and whether they are apart, kept for the calibration."""
    for batch in batches:
        rows, labels, outside, ids, apart = [], [], [], [], []
        for value in batch.column("text"):
            for row, label, out, own, source in _examples(value.as_py()):
                rows.append(row)
                labels.append(label)
                outside.append(out)
                ids.append(f"{own}|{int(row[0])}")
                apart.append(zlib.crc32(source.encode("utf-8", "surrogatepass")) % 4 == 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32()), pa.array(outside, pa.bool_()), pa.array(ids, pa.string()), pa.array(apart, pa.bool_())],
            names=["features", "label", "outside", "value", "apart"],
        )


def _binned(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("features").flatten().to_numpy().reshape(len(batch), -1)
                bins = pa.array([row.tobytes() for row in binned(x, edges)], pa.binary())
                others = [batch.column(c) for c in ("label", "outside", "apart", "n")]
                yield pa.RecordBatch.from_arrays([bins, pa.array(x[:, 0].astype(np.int32)), *others], names=["bins", "kind", "label", "outside", "apart", "n"])

    return run


def _unbinned(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(len(batch), -1)


def _sums(model: Trees, features: np.ndarray, cuts: np.ndarray, level: int):
    """One row a task: the sums of ``histogram``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = 0
        for batch in batches:
            if len(batch):
                y, n = (batch.column(c).to_numpy().astype(np.float64) for c in ("label", "n"))
                out = out + histogram(_unbinned(batch), y, n, model, features, cuts, level)
        if not np.isscalar(out):
            yield pa.RecordBatch.from_arrays([pa.array([out.ravel()], pa.list_(pa.float64()))], names=["sums"])

    return run


def _steps(model: Trees, edges: list[np.ndarray]):
    """The step of each row's score."""
    # A bin is above the cuts that its value is above.
    own = Trees(model.start, model.features, [np.array([np.searchsorted(edges[k], c) if np.isfinite(c) else c for k, c in zip(f, v, strict=True)]) for f, v in zip(model.features, model.cuts, strict=True)], model.leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                step = np.floor(own.scores(_unbinned(batch)) * STEPS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(step), batch.column("label"), batch.column("n")], names=["kind", "step", "label", "n"])

    return run


def _threshold(steps: list[tuple[int, int, int]]) -> float:
    """The least score from which on the precision is reached, of steps with their rows and right ones; one if there is none."""
    total, right, least = 0, 0, 1.0
    steps = sorted(steps, reverse=True)
    for (_, n, good), (below, *_) in zip(steps, [*steps, (-1,)][1:], strict=True):
        total, right = total + n, right + good
        if right >= PRECISION * total:
            least = max(0.5, (below + 1) / STEPS)
    return least


def fit(docs: DataFrame) -> Model:
    """Train on all proposals in ``docs`` (``text``)."""
    schema = "features array<double>, label int, outside boolean, value string, apart boolean"
    rows = docs.filter("text IS NOT NULL").select("text").mapInArrow(_labelled, schema)
    # Copies of a text count once.
    rows = rows.groupBy("value", "label", "outside", "apart").agg(F.min("features").alias("features"))
    rows = tables.written(rows.groupBy("features", "label", "outside", "apart").agg(F.count("*").alias("n")), "pii-proposals")
    learned = "CASE WHEN NOT apart THEN {} END".format
    levels = f"array({', '.join(map(repr, LEVELS.tolist()))})"
    values = [F.expr(f"percentile({learned(f'features[{k}]')}, {levels}, n)") for k in range(len(FEATURES))]
    n, share, right, *values = rows.agg(F.sum("n"), F.expr(f"sum({learned('n')})"), F.expr(f"sum({learned('n * label')})"), *values).first()
    if (n or 0) < 20 or not 0 < (right or 0) < share:
        return Model(Trees(), [1.0] * len(KINDS))
    edges = [np.unique(v) for v in values]
    schema = "bins binary, kind int, label int, outside boolean, apart boolean, n long"
    bins = rows.mapInArrow(_binned(edges), schema).groupBy("bins", "kind", "label", "outside", "apart").agg(F.sum("n").alias("n"))
    bins = tables.written(bins, "pii-bins")
    train = bins.filter("NOT apart").select("bins", "label", "n")

    def sums(model: Trees, features: np.ndarray, cuts: np.ndarray, level: int) -> np.ndarray:
        # A row a task of at most some 6,000 numbers.
        found = train.mapInArrow(_sums(model, features, cuts, level), "sums array<double>").collect()
        return np.sum([r["sums"] for r in found], axis=0).reshape(len(FEATURES), 2**level, 2, BINS)

    trees = Trees.grown(edges, right / share, sums)
    # Only proposals outside the fixed spans can be added.
    apart = bins.filter("apart AND outside").mapInArrow(_steps(trees, edges), "kind int, step int, label int, n long")
    found = apart.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good")).collect()
    return Model(trees, [_threshold([(r["step"], r["n"], r["good"]) for r in found if r["kind"] == k]) for k in range(len(KINDS))])


SPAN = "array<struct<kind: string, begin: int, end: int, score: double>>"


def _scan(model: Model):
    kind_of = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed, added = [], []
            for value in batch.column("text"):
                a, b = model.select(value.as_py() or "")
                fixed.append([{"kind": KINDS[k], "begin": x, "end": y, "score": 1.0} for k, x, y in a])
                added.append([{"kind": KINDS[k], "begin": x, "end": y, "score": s} for k, x, y, s in b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fixed, pa.list_(kind_of)), pa.array(added, pa.list_(kind_of))],
                names=["doc_id", "fixed", "added"],
            )

    return run


def scan(docs: DataFrame, model: Model, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, spans ``fixed`` by the patterns and ``added`` by the model, by kind and begin."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(texts).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_scan(model), f"doc_id {kind}, fixed {SPAN}, added {SPAN}")
