"""Personal data by weak supervision.

Candidate spans come from loose patterns per kind. Labelers vote on each candidate: regex (the strict forms),
checks (Luhn, octets), gazetteers (hosts, endings, calling codes, issuers), context words around it, and shape.
A vote is 1 (for), -1 (against) or 0 (abstains). Expectation-maximisation estimates each labeler's reliability
from how often the votes come together, over all documents (counts of patterns, a bounded table), and gives each
combination of votes a probability. A candidate that its kind's own rule (Luhn, octets, ending) speaks against is out. On the
others a logistic span classifier is trained to give those probabilities from traits of the span that are no votes: its length, its
separators, what stands before and behind it. It learns from all candidates, certain ones too, what a span of the kind looks like, and so
decides where votes are few or even. Spans of the base patterns are always given; the classifier adds spans that they do not have.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import as_bytes, bounded_batches, texts

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Loose forms, one per kind: addresses written out, quads with other separators, local phone numbers.
_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]++"
                        r"(?:(?:\.|\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?)[A-Za-z0-9-]++)++"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[.\x20-]?[0-9]{4}){2}[.\x20-]?[0-9]{3,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])"),
}
#: Gazetteers and context words of the labelers.
_ENDINGS = frozenset("com org net edu gov io info biz uk de fr es it nl eu us ca au jp".split())
_HOSTS = ("mail", "smtp", "post", "inbox", "contact")
_ISSUER = ("34", "37", "4", "5", "6")
_CONTEXT = {
    "email": ("mail", "contact", "write", "reply"), "ip": ("ip", "host", "server", "addr", "login"),
    "card": ("card", "visa", "credit", "pay", "amex"), "phone": ("phone", "tel", "call", "mobile", "fax"),
}
_AGAINST = ("order", "invoice", "isbn", "version", "serial", "sku", "license", "figure")
#: Votes of a labeler may be this many: for, against, none.
LABELERS = ("regex", "check", "gazetteer", "context", "shape")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind, in the order of ``KINDS``."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        last = found.end() if found else at + 1
        if found:
            out.append(("email", start, last))
        at = text.find("@", last)
    out += [("ip", *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, is base): base spans, and loose ones that touch no base span of any kind."""
    base = base_spans(text)
    out = [(*span, True) for span in base]
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    for kind in KINDS:
        for m in _LOOSE[kind].finditer(text):
            k = int(np.searchsorted(starts, m.end(), side="left"))
            if k == 0 or reach[k - 1] <= m.start():
                out.append((kind, *m.span(), False))
    return out


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote per labeler for the span."""
    span = text[start:end]
    digits = _digits(span)
    around = text[max(0, start - 40):start].lower() + " " + text[end:end + 20].lower()
    if kind == "email":
        name = re.split(r"@|[\[(]\x20?(?:at|AT)\x20?[\])]", span)[-1].lower()
        check = 1 if re.fullmatch(r"[a-z]{2,}", re.split(r"[.\])\x20]", name)[-1]) else -1
        gazetteer = 1 if re.split(r"[.\])\x20]", name)[-1] in _ENDINGS or any(h in name for h in _HOSTS) else 0
    elif kind == "ip":
        parts = [p for p in re.split(r"[^0-9]+", span) if p]
        check = 1 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        gazetteer = -1 if parts[0] == "0" or all(len(p) == 1 for p in parts) else 0
    elif kind == "card":
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(_ISSUER) and len(digits) in (15, 16) else -1
    else:
        check = 1 if 10 <= len(digits) <= 13 else 0
        gazetteer = 1 if digits.startswith("1") or "555" in digits else 0
    context = 1 if any(w in around for w in _CONTEXT[kind]) else -1 if any(w in around for w in _AGAINST) else 0
    left, right = text[start - 1:start], text[end:end + 1]
    shape = -1 if left.isalnum() or right.isalnum() or len(set(digits)) == 1 else 1
    return (1 if base else -1, check, gazetteer, context, shape)


#: Number of values of each trait; with the votes they bound the table of patterns that reaches the driver.
TRAITS = (4, 5, 5, 4)


def traits(text: str, start: int, end: int) -> tuple[int, ...]:
    """Length, separators inside, and what stands before and behind the span, as small numbers (``TRAITS``)."""
    span = text[start:end]
    length = int(np.searchsorted((12, 16, 24), len(span), side="right"))
    marks = {c for c in span if not c.isalnum()}
    inside = 0 if not marks else 1 if marks <= {" "} else 2 if marks <= {".", "@"} else 3 if marks <= {"-", " ", "+", "(", ")"} else 4
    before = text[max(0, start - 3):start].rstrip(" \t")[-1:]
    ahead = 0 if not before or before in "\r\n" else 1 if before in ":=#" else 2 if before.isdigit() else 3 if before.isalpha() else 4
    after = text[end:end + 1]
    behind = 0 if not after or after.isspace() else 1 if after in ".,;:!?)]" else 2 if after.isalnum() else 3
    return length, inside, ahead, behind


def _interesting(column: pa.Array) -> np.ndarray:
    """Rows that hold a digit, an @ or a bracketed ``at``; no pattern matches elsewhere."""
    raw, offsets = as_bytes(column)
    mark = ((raw >= 48) & (raw <= 57)) | (raw == 64) | (raw == 91) | (raw == 40)
    counts = np.concatenate([[0], np.cumsum(mark)])
    return counts[offsets[1:]] > counts[offsets[:-1]]


@dataclass
class Model:
    """Reliability of each labeler per kind, and the weights of the span classifier."""

    reliability: dict[str, np.ndarray]
    weights: dict[str, np.ndarray]
    threshold: float = 0.5

    def probability(self, kind: str, trait: tuple[int, ...]) -> float:
        w = self.weights.get(kind)
        return 0.0 if w is None else float(1 / (1 + np.exp(-np.dot(w, _features(trait)))))


def _features(trait: tuple[int, ...]) -> np.ndarray:
    return np.array([1.0, *[float(t == k) for t, n in zip(trait, TRAITS, strict=True) for k in range(n)]])


def _ruled_out(vote: tuple[int, ...]) -> bool:
    return vote[LABELERS.index("check")] == -1


def reliabilities(vote: np.ndarray, count: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (rows) and their counts: how often each labeler is right, and each pattern's probability.

    One hidden label per candidate; a labeler is right with its own probability when it votes. Classes are told apart by starting
    from the majority.
    """
    truth = np.clip(0.5 + vote.sum(axis=1) / (2 * vote.shape[1]), 0.05, 0.95)
    for _ in range(rounds):
        share = min(max((count * truth).sum() / count.sum(), 0.02), 0.98)
        right = ((vote == 1) * (count * truth)[:, None] + (vote == -1) * (count * (1 - truth))[:, None]).sum(axis=0)
        said = ((vote != 0) * count[:, None]).sum(axis=0)
        accurate = np.clip((right + 4) / (said + 5), 0.05, 0.97)  # a weak belief that labelers are mostly right
        odds = np.log(share / (1 - share)) + (vote * np.log(accurate / (1 - accurate))).sum(axis=1)
        truth = 1 / (1 + np.exp(-odds))
    return accurate, truth


def logistic(x: np.ndarray, truth: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on probabilities, by Newton's steps; ``weight`` sums to 1."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (weight * (p - truth)) + ridge * w)
        w -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit_counts(rows: list[tuple[str, tuple[int, ...], tuple[int, ...], int]]) -> Model:
    """``rows``: kind, votes, traits and how many candidates had them. An empty list gives a model that adds nothing."""
    reliability, weights = {}, {}
    for kind in KINDS:
        own = [(v, t, n) for k, v, t, n in rows if k == kind]
        if not own:
            continue
        vote, of = np.unique(np.array([v for v, _, _ in own]), axis=0, return_inverse=True)
        count = np.array([n for _, _, n in own], float)
        reliability[kind], truth = reliabilities(vote, np.bincount(of.ravel(), count))
        passed = [k for k, (v, _, _) in enumerate(own) if not _ruled_out(v)]
        if passed:
            x = np.stack([_features(own[k][1]) for k in passed])
            weights[kind] = logistic(x, truth[of.ravel()[passed]], count[passed] / count[passed].sum())
    return Model(reliability, weights)


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Model from the votes and traits of all candidates in all documents.

    Patterns are counted in the tasks and combined before the shuffle; at most 4 * 3^5 * 400 patterns of some 40 bytes reach the driver,
    however many documents there are. Null and empty texts have no candidates; an empty table gives a model that adds nothing.
    """
    bounded_batches()

    @F.arrow_udf("map<string,bigint>")
    def patterns(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            rows = np.flatnonzero(_interesting(batch))
            some = dict(zip(rows.tolist(), texts(batch.take(pa.array(rows))), strict=True))
            for row in range(len(batch)):
                seen: dict[str, int] = {}
                for kind, start, end, base in candidates(some[row]) if row in some else ():
                    key = kind + ":" + ",".join(map(str, votes(some[row], kind, start, end, base) + traits(some[row], start, end)))
                    seen[key] = seen.get(key, 0) + 1
                out.append(list(seen.items()))
            yield pa.array(out, pa.map_(pa.string(), pa.int64()))

    counted = (docs.select(F.explode(patterns(F.col(text_col))).alias("pattern", "n"))
               .groupBy("pattern").agg(F.sum("n").alias("n")))
    rows = []
    for r in sorted(counted.collect()):
        kind, _, pattern = r["pattern"].partition(":")
        values = tuple(map(int, pattern.split(",")))
        rows.append((kind, values[:len(LABELERS)], values[len(LABELERS):], r["n"]))
    return fit_counts(rows)


def spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans, each by start and then by kind as listed."""
    base, every = [], []
    for kind, start, end, is_base in candidates(text):
        if is_base:
            base.append((kind, start, end))
        if is_base or _adds(text, kind, start, end, model):
            every.append((kind, start, end))
    key = lambda s: (s[1], KINDS.index(s[0]))
    return sorted(base, key=key), sorted(every, key=key)


def _adds(text: str, kind: str, start: int, end: int, model: Model) -> bool:
    out = _ruled_out(votes(text, kind, start, end, False))
    return not out and model.probability(kind, traits(text, start, end)) >= model.threshold


def written(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_FOUND = pa.struct([(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())])


def find(text: Column, model: Model) -> Column:
    """Struct column: base spans per kind, digest of the base spans, all spans. Null counts as empty."""
    bounded_batches()

    @F.arrow_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        nothing = {f"n_{k}": 0 for k in KINDS} | {"base_sha256": hashlib.sha256(b"").hexdigest(), "spans": ""}
        for batch in batches:
            out = [nothing] * len(batch)
            rows = np.flatnonzero(_interesting(batch))
            for row, t in zip(rows.tolist(), texts(batch.take(pa.array(rows))), strict=True):
                base, every = spans(t, model)
                out[row] = ({f"n_{k}": sum(s[0] == k for s in base) for k in KINDS}
                            | {"base_sha256": hashlib.sha256(written(base).encode()).hexdigest(), "spans": written(every)})
            yield pa.array(out, _FOUND)

    return run(text)


def redact(text: Column, model: Model) -> Column:
    """Text with all spans replaced by their kind; null stays null."""
    bounded_batches()

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = np.flatnonzero(_interesting(batch))
            changed = [redacted(t, spans(t, model)[1]) for t in texts(batch.take(pa.array(rows)))]
            picked = np.zeros(len(batch), bool)
            picked[rows] = True
            yield pa.compute.replace_with_mask(batch.cast(pa.string()), pa.array(picked), pa.array(changed, pa.string()))

    return run(text)


def find_documents(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, repeated rows too. Without a model one is fitted on the same documents first.

    Null and empty texts have no spans (zeros, the digest of nothing, an empty list); an empty table gives no rows; other columns are
    neither read nor returned.
    """
    model = model or fit(docs, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), find(F.col(text_col), model).alias("f")).select("doc_id", "f.*")
