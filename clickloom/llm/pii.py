"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field is trained from a small labelled table and decoded by Viterbi in numpy batches. It labels runs of words
that hold a digit or an at sign; any other word is outside by definition, so a chain splits there without loss and
the work follows the number of such words. Its spans are added where no pattern has found anything.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from clickloom.llm.common import per_text
from clickloom.llm.pii_labels import labelled_rows

KINDS = ("email", "ip", "card", "phone")
#: Labelled rows that training may take.
LABELLED_ROWS = 5000

# The patterns asked for. Quantifiers are possessive where nothing shorter could match.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MARKED = re.compile(r"[0-9@]\S*")
DIGITS = re.compile(r"[0-9]")

RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the patterns, leftmost and non-overlapping per kind, in order."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        head = text[free:at]
        size = len(head) - len(head.rstrip(LOCAL))
        tail = DOMAIN.match(text, at + 1) if size else None
        if tail:
            found.append((at - size, 0, tail.end()))
        free = tail.end() if tail else at + 1
        at = text.find("@", free)
    for m in IP.finditer(text):
        # Leading zeros aside, four digits are over 255 already.
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_only_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass(frozen=True)
class Word:
    start: int
    end: int
    text: str
    before: str  # the word before, if it stands on the same side of a gap
    joined: bool  # directly follows another marked word


def marked_words(text: str) -> list[Word]:
    """Words with a digit or an at sign, and whether they follow each other."""
    out: list[Word] = []
    last = 0
    for m in MARKED.finditer(text):
        gap = text[last:m.start()]
        parts = gap.rsplit(None, 1)
        head = "" if not parts or gap[-1:].isspace() else parts[-1]
        start = m.start() - len(head)
        earlier = gap[:len(gap) - len(head)].split()
        joined = bool(out) and not earlier and start > out[-1].end
        before = out[-1].text if joined else (earlier[-1] if earlier else "")
        out.append(Word(start, m.end(), text[start:m.end()], before, joined))
        last = m.end()
    return out


def shape(word: str) -> str:
    return "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word)


def collapsed(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", shape(word))


def _ip_like(word: str) -> bool:
    parts = word.split(".")
    return len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) <= 255 for p in parts)


def features(words: list[Word]) -> list[list[str]]:
    """Features of each marked word: its shape, digits and marks, and the words beside it."""
    bare = [w.text.rstrip(".,;:!?\"'") for w in words]
    kinds = [collapsed(b) for b in bare]
    out = []
    for i, w in enumerate(words):
        digits = _only_digits(bare[i])
        own = ["bias", f"kind={kinds[i]}", f"digits={min(len(digits), 20)}",
               f"shape={shape(bare[i])}" if len(bare[i]) <= 24 else "long"]
        if 12 <= len(digits) <= 19 and len(digits) == len(bare[i].replace("-", "")):
            own.append(f"luhn={luhn(digits)}")
        if _ip_like(bare[i]):
            own.append("ip")
        if "@" in bare[i]:
            own.append(f"at={bool(bare[i].split('@')[0])},{'.' in bare[i].split('@')[-1]}")
        if bare[i][:1] in "+(":
            own.append(f"first={bare[i][:1]}")
        next_ = kinds[i + 1] if i + 1 < len(words) and words[i + 1].joined else "-"
        last_ = kinds[i - 1] if w.joined else "-"
        own += [f"last={last_}", f"next={next_}", f"last={last_},kind={kinds[i]}", f"next={next_},kind={kinds[i]}"]
        if not w.joined:
            own.append(f"word={w.before.lower()}")
        out.append(own)
    return out


# Labels: outside, then begin and inside of each kind.
LABELS = 1 + 2 * len(KINDS)
_NEVER = -1e9


def _allowed() -> np.ndarray:
    """Inside follows only begin or inside of its kind."""
    out = np.zeros((LABELS, LABELS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = _NEVER
        out[[inside - 1, inside], inside] = 0
    return out


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass(frozen=True)
class Field:
    index: dict[str, int]
    weights: np.ndarray  # features by labels
    steps: np.ndarray  # label by next label; chains begin and end outside

    def scores(self, words: list[Word]) -> np.ndarray:
        out = np.zeros((len(words), LABELS))
        for i, own in enumerate(features(words)):
            known = [self.index[f] for f in own if f in self.index]
            out[i] = self.weights[known].sum(axis=0)
        return out

    def decode(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Viterbi over many chains at once; chain i is rows starts[i] up to starts[i] + sizes[i]."""
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        label = np.zeros(len(scores), np.int64)
        back = np.zeros((len(scores), LABELS), np.int8)
        best = scores[starts] + self.steps[0]
        ends = np.zeros(best.shape)
        for t in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -t, "left"))  # chains longer than t
            done = int(np.searchsorted(-sizes, -t, "right"))
            ends[live:done] = best[live:done]
            if not live:
                break
            paths = best[:live, :, None] + self.steps[None]
            rows = starts[:live] + t
            back[rows] = paths.argmax(axis=1)
            best = paths.max(axis=1) + scores[rows]
            best = np.concatenate([best, np.zeros((len(sizes) - live, LABELS))])
        if len(sizes):
            now = (ends + self.steps[:, 0]).argmax(axis=1)
            for t in range(int(sizes[0]) - 1, -1, -1):
                live = int(np.searchsorted(-sizes, -t, "left"))
                rows = starts[:live] + t
                label[rows] = now[:live]
                now = np.concatenate([back[rows, now[:live]], now[live:]]).astype(np.int64)
        return label


def _chains(words: list[Word]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero([not w.joined for w in words])
    return starts, np.diff(np.append(starts, len(words)))


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and text[end - 1] in ".,;:!?\"'>]}":
        end -= 1
    while end > start and text[start] in "\"'<[{,;:.":
        start += 1
    if text.find(")", start, end) < 0 and text[start:start + 1] == "(":
        start += 1
    return start, end - (text[end - 1:end] == ")" and text.find("(", start, end) < 0)


def train(rows: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 300, decay: float = 0.02) -> Field:
    """A field from ``(text, [(kind, start, end)])``, by gradient steps on the penalised likelihood."""
    if len(rows) > LABELLED_ROWS:
        raise ValueError(f"{len(rows)} labelled rows; the bound is {LABELLED_ROWS}")
    index: dict[str, int] = {}
    chains: list[tuple[list[list[int]], list[int]]] = []
    for text, spans in rows:
        words = marked_words(text)
        seen = [[index.setdefault(f, len(index)) for f in own] for own in features(words)]
        label = []
        for w in words:
            hit = next(((k, s) for k, s, e in spans if w.start < e and w.end > s), None)
            begin = hit and w.start <= hit[1]
            label.append(0 if hit is None else 1 + 2 * KINDS.index(hit[0]) + (not begin))
        for s, n in zip(*_chains(words), strict=True):
            chains.append((seen[s:s + n], label[s:s + n]))
    longest = max((len(c) for c, _ in chains), default=0)
    present = np.zeros((longest, len(chains)), bool)
    design = np.zeros((longest, len(chains), len(index)), np.float32)
    gold = np.zeros((longest, len(chains)), np.int64)
    for c, (seen, label) in enumerate(chains):
        for t, own in enumerate(seen):
            present[t, c] = True
            design[t, c, own] = 1
            gold[t, c] = label[t]
    weights, steps = np.zeros((len(index), LABELS)), np.zeros((LABELS, LABELS))
    allowed = _allowed()
    eye = np.eye(LABELS)
    moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(steps), np.zeros_like(steps)]]
    for turn in range(1, rounds + 1):
        score = design @ weights
        move = steps + allowed
        forward = np.zeros((longest, len(chains), LABELS))
        backward = np.zeros_like(forward)
        for t in range(longest):
            into = move[0] if t == 0 else _sum_exp(forward[t - 1][:, :, None] + move, 1)
            forward[t] = score[t] + into
        last = np.vstack([present[1:], np.zeros((1, len(chains)), bool)])
        for t in range(longest - 1, -1, -1):
            backward[t] = move[:, 0]
            if t + 1 < longest:
                onward = _sum_exp(move[None] + (score[t + 1] + backward[t + 1])[:, None, :], 2)
                backward[t] = np.where(last[t][:, None], onward, backward[t])
        total = _sum_exp(forward[0] + backward[0], 1)
        chance = np.exp(forward + backward - total[None, :, None]) * present[:, :, None]
        surplus = chance - eye[gold] * present[:, :, None]
        grad_w = np.tensordot(design, surplus, axes=([0, 1], [0, 1])) + decay * weights
        grad_s = decay * steps
        grad_s[0] += surplus[0].sum(axis=0)
        for t in range(longest):
            end = present[t] & ~last[t]
            grad_s[:, 0] += surplus[t][end].sum(axis=0)
            if t + 1 < longest and last[t].any():
                pair = np.exp(forward[t][:, :, None] + move + (score[t + 1] + backward[t + 1])[:, None, :]
                              - total[:, None, None])[last[t]].sum(axis=0)
                np.add.at(pair, (gold[t][last[t]], gold[t + 1][last[t]]), -1)
                grad_s += pair
        for value, grad, (first, second) in ((weights, grad_w, moments[0]), (steps, grad_s, moments[1])):
            first += 0.1 * (grad - first)
            second += 0.01 * (grad**2 - second)
            value -= 0.1 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return Field(index, weights, steps + allowed)


@cache
def default_field() -> Field:
    return train(labelled_rows())


def spans_of(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Of each text: the spans of the patterns, and these with the field's further spans."""
    words = [marked_words(t) for t in texts]
    flat = [w for own in words for w in own]
    label = field.decode(field.scores(flat), *_chains(flat)) if flat else np.zeros(0, np.int64)
    out, at = [], 0
    for text, own in zip(texts, words, strict=True):
        base = base_spans(text)
        ends = sorted((s, e) for s, _, e in base)
        more: list[tuple[int, int, int]] = []
        held: list[int] | None = None
        for w, y in zip([*own, None], [*label[at:at + len(own)].tolist(), 0], strict=True):
            if held and (y == 0 or y % 2 == 1):
                start, end = _trimmed(text, held[0], held[2])
                if end > start:
                    more.append((start, held[1], end))
                held = None
            if w is not None and y:
                held = [held[0], held[1], w.end] if held and y % 2 == 0 else [w.start, (y - 1) // 2, w.end]
        at += len(own)
        out.append((base, sorted(base + _apart(more, ends))))
    return out


def _apart(more: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``more`` (in order) that meet no span of ``taken`` (in order)."""
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0)
    firsts = [s for s, _ in taken]
    kept = []
    for span in more:
        before = int(np.searchsorted(firsts, span[2], "left"))  # those that begin before its end
        if not before or reach[before - 1] <= span[0]:
            kept.append(span)
    return kept


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_sha256 and spans; columns of these names are replaced.

    Counts and digest are those of the patterns; spans adds what the field finds apart from them. A null text is
    empty: no spans, the digest of the empty string. Equal texts get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or default_field())

    def label(texts: pd.Series) -> pd.DataFrame:
        found = []
        for base, spans in spans_of([t or "" for t in texts], shared.value):
            counts = np.bincount([k for _, k, _ in base], minlength=len(KINDS)).tolist()
            found.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        return pd.DataFrame(found, columns=[part.split()[0] for part in RESULT.split(", ")])

    return per_text(docs, label, RESULT)


def mask(docs: DataFrame, field: Field | None = None, sign: str = "*") -> DataFrame:
    """``docs`` with every character of personal data in ``text`` replaced by ``sign``; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field or default_field())

    def hide(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text, (_, spans) in zip(texts, spans_of([t or "" for t in texts], shared.value), strict=True):
            parts, at = [], 0
            for start, _, end in spans:
                parts += [(text or "")[at:start], sign * (end - max(start, at))]
                at = max(at, end)
            out.append(None if text is None else "".join([*parts, text[at:]]))
        return pd.DataFrame({"text": out})

    names = docs.columns
    return per_text(docs.withColumn("_text", docs["text"]), hide, "text string", "_text").select(*names)
