"""Personal data: fixed patterns, and a character-level BiLSTM with CRF.

The patterns are exact and always stay. The network adds spans the patterns
miss: values written out (``name at host dot org``), grouped in another way,
or run together with the next value. It reads overlapping windows of
characters: every kind it knows has a digit, an ``@`` or the word ``dot``, so
windows without any of them cannot hold a span and are not read. Each window
is decoded on its own; globally, every character takes its tag from the
window in which it lies most centrally. The network is trained in numpy from
labelled spans: those of the patterns, and values in other notations planted
between the words of the same documents, beside numbers that are none.

NULL and blank texts have no spans; a very long text is read in the windows
round its marks only, in steps of bounded memory; rows that repeat get equal
results, whatever their order; an empty table trains no network.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.llm.bpe import text_groups
from racelake.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the contract; possessive runs and the look-behind only
# keep them from trying starts that cannot match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile(r"[0-9@]")
_DOT = re.compile(r"dot(?![A-Za-z])")
_WRITTEN = re.compile(r"\bat\b.*\bdot\b|\bat\b.*\.|@.*\bdot\b")
_NUMBER = re.compile(r"[0-9]+")
# Outside the patterns' spans, what may be a value in another notation.
_DOUBT = re.compile(r"(?<![A-Za-z0-9])[0-9+(][0-9 ().+/-]{7,}[0-9](?![A-Za-z0-9])|@")

WINDOW, STRIDE = 96, 48
TRAIN_WINDOWS = 1_500  # at most, labelled by the patterns; of the documents of least id hash
PLANTED_WINDOWS = 3_000  # at most, with planted values; of the same documents
TRAIN_DOCS = 4_000  # documents looked at for them, about
EPOCHS, HIDDEN, EMBED = 12, 24, 12
CONFIDENCE = 0.8  # least posterior of every character of an added span

# Notations that the patterns do not see (9: a digit, n: a name, h: a host,
# t: a top-level domain), separators of card and address groups, and numbers
# that are no personal data.
NOTATIONS = {
    "email": ("n at h dot t", "n [at] h [dot] t", "n(at)h(dot)t", "n @ h . t", "n @ h.t", "n@h",
              "n@h dot t", "n at h dot t", "n (at) h dot t"),
    "phone": ("999-999-9999", "(999) 999-9999", "999 999 9999", "999.999.9999", "0999 999 9999", "0999-9999999",
              "00 99 999 999 9999", "9-999-999-9999", "99 9999 9999"),
}
CARD_MARKS = (".", "  ", " - ", "/", "_", ":", ", ", " . ", "--", " :")
IP_MARKS = ("[.]", " . ", "(.)", " dot ", "[dot]", " .", " (.) ")
OTHER_NUMBERS = ("9999-99-99", "99.99.9999", "99/99/9999", "99:99:99", "9999-99-99 99:99:99", "9.9", "9.9.9", "99,999.99",
                 "99 999", "9 999 999", "#99999", "99999999", "99%", "99-99", "(99)", "9999-9999", "99.9.9", "999x999",
                 "dot 9", "at 99:99", "9 dot 9", "the dot", "at the dot")


def _emails(text: str):
    """Leftmost non-overlapping matches, found from each ``@``: the local
    part is the whole run before it, as far as the last match reached."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns, by kind and start."""
    out = [(0, s, e) for s, e in _emails(text)]
    if not _TRIGGER.search(text):
        return out
    out += [(1, *m.span()) for m in _IP.finditer(text)
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


# --- characters, windows, tags ------------------------------------------------

# Classes: one per mark that matters, digits, lower, upper, other letters,
# space, line break, the rest, and 0 beside the text.
_MARKS = "@.+-()_%/:,=\"'#[]adot"  # the letters of the written-out marks have their own
N_CLASSES = 7 + len(_MARKS)
N_TAGS = 1 + 2 * len(KINDS)  # outside; first and further character of a kind


def _class_table() -> np.ndarray:
    t = np.full(128, 6, np.int8)
    t[ord("0"):ord("9") + 1] = 1
    t[ord("a"):ord("z") + 1] = 2
    t[ord("A"):ord("Z") + 1] = 3
    t[ord(" ")] = 4
    t[[10, 13]] = 5
    for i, c in enumerate(_MARKS):
        t[ord(c)] = 7 + i
    return t


_CLASSES = _class_table()


def classes(text: str) -> np.ndarray:
    """A class per code point (letters beyond ASCII count as lower case)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, _CLASSES[np.minimum(points, 127)], 2)


def window_starts(text: str) -> np.ndarray:
    """Starts (multiples of STRIDE, from -STRIDE/2) of the windows whose own
    middle, widened by a quarter each side, holds a digit, ``@`` or ``dot``."""
    hits = [m.start() for m in _TRIGGER.finditer(text)]
    hits += [m.start() for m in _DOT.finditer(text) if not text[m.start() - 1:m.start()].isalpha()]
    hits = np.array(hits, np.int64)
    if not len(hits):
        return hits
    half = STRIDE // 2
    cell = np.unique(np.concatenate([(hits - half) // STRIDE, hits // STRIDE, (hits + half) // STRIDE]))
    cell = cell[(cell >= 0) & (cell * STRIDE < len(text))]
    return cell * STRIDE - half


def _cut(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([np.zeros(WINDOW, x.dtype), x, np.zeros(WINDOW, x.dtype)])
    return padded[starts[:, None] + WINDOW + np.arange(WINDOW)]


def tags_of(n: int, spans) -> np.ndarray:
    t = np.zeros(n, np.int8)
    for kind, s, e in spans:
        t[s:e] = 2 + 2 * kind
        t[s] = 1 + 2 * kind
    return t


# --- the network ------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    p: dict[str, np.ndarray]

    @staticmethod
    def initial(seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        p = {"embed": g(N_CLASSES, EMBED), "out": g(2 * HIDDEN, N_TAGS), "bias": np.zeros(N_TAGS, np.float32),
             "move": np.zeros((N_TAGS, N_TAGS), np.float32)}
        for d in "fb":
            p[f"x{d}"], p[f"h{d}"] = g(EMBED, 4 * HIDDEN), g(HIDDEN, 4 * HIDDEN)
            p[f"c{d}"] = np.zeros(4 * HIDDEN, np.float32)
            p[f"c{d}"][HIDDEN:2 * HIDDEN] = 1  # remember at first
        return Network(p)

    def _direction(self, d: str, x: np.ndarray, keep: bool):
        """LSTM states (time, batch, hidden) over embedded windows."""
        p, H = self.p, HIDDEN
        t, b, _ = x.shape
        pre = x @ p[f"x{d}"] + p[f"c{d}"]
        h, c = np.zeros((b, H), np.float32), np.zeros((b, H), np.float32)
        out, tape = np.empty((t, b, H), np.float32), []
        for k in (range(t) if d == "f" else range(t - 1, -1, -1)):
            z = pre[k] + h @ p[f"h{d}"]
            gates = _sigmoid(z[:, :3 * H])
            i, f, o = gates[:, :H], gates[:, H:2 * H], gates[:, 2 * H:]
            g = np.tanh(z[:, 3 * H:])
            last_h, last_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[k] = h
            if keep:
                tape.append((k, i, f, o, g, tc, last_h, last_c))
        return out, tape

    def emissions(self, windows: np.ndarray, keep: bool = False):
        x = self.p["embed"][windows.T]
        f, tf = self._direction("f", x, keep)
        b, tb = self._direction("b", x, keep)
        h = np.concatenate([f, b], axis=2)
        return h @ self.p["out"] + self.p["bias"], (x, h, tf, tb)

    def posteriors(self, e: np.ndarray):
        """CRF: log normaliser and tag marginals by forward and backward
        sums, scaled at each place, and what pair marginals are made of."""
        move, t = self.p["move"].astype(np.float64), len(e)
        peak, top = e.max(axis=2, keepdims=True), move.max()
        m, x = np.exp(move - top), np.exp((e - peak).astype(np.float64))
        a, z, scale = np.empty_like(x), np.empty_like(x), np.empty(x.shape[:2])
        for k in range(t):
            now = (a[k - 1] @ m) * x[k] if k else x[0]
            scale[k] = now.sum(1)
            a[k] = now / scale[k][:, None]
        z[t - 1] = 1
        for k in range(t - 2, -1, -1):
            z[k] = (x[k + 1] * z[k + 1]) @ m.T / scale[k + 1][:, None]
        total = np.log(scale).sum(0) + peak[:, :, 0].sum(0) + (t - 1) * top
        return total, a * z, (a[:-1], m, x[1:] * z[1:] / scale[1:, :, None])

    def loss_and_gradient(self, windows: np.ndarray, tags: np.ndarray):
        p, H = self.p, HIDDEN
        e, (x, h, tf, tb) = self.emissions(windows, keep=True)
        e = e.astype(np.float64)
        total, marg, (before, m, after) = self.posteriors(e)
        t, b, _ = e.shape
        y = tags.T
        gold = np.take_along_axis(e, y[:, :, None], 2).sum((0, 2)) + p["move"][y[:-1], y[1:]].sum(0)
        loss = float((total - gold).sum()) / b
        de = marg.copy()
        np.put_along_axis(de, y[:, :, None], np.take_along_axis(de, y[:, :, None], 2) - 1, 2)
        dmove = m * (before.reshape(-1, N_TAGS).T @ after.reshape(-1, N_TAGS))
        np.add.at(dmove, (y[:-1], y[1:]), -1)
        de = (de / b).astype(np.float32)
        g = {"move": (dmove / b).astype(np.float32), "bias": de.sum((0, 1)),
             "out": h.reshape(-1, 2 * H).T @ de.reshape(-1, N_TAGS)}
        dh = de @ p["out"].T
        dx = np.zeros_like(x)
        for d, tape, part in (("f", tf, dh[:, :, :H]), ("b", tb, dh[:, :, H:])):
            gx, gh, gc = (np.zeros_like(p[n + d]) for n in "xhc")
            nh, nc = np.zeros((b, H), np.float32), np.zeros((b, H), np.float32)
            for k, i, f, o, gg, tc, last_h, last_c in reversed(tape):
                dhk = part[k] + nh
                dc = nc + dhk * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * last_c * f * (1 - f),
                                     dhk * tc * o * (1 - o), dc * i * (1 - gg * gg)], axis=1)
                gx += x[k].T @ dz
                gh += last_h.T @ dz
                gc += dz.sum(0)
                dx[k] += dz @ p[f"x{d}"].T
                nh, nc = dz @ p[f"h{d}"].T, dc * f
            g[f"x{d}"], g[f"h{d}"], g[f"c{d}"] = gx, gh, gc
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], windows.T.ravel(), dx.reshape(-1, EMBED))
        return loss, g

    def fit(self, windows: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, batch: int = 64,
            rate: float = 0.02, seed: int = 7) -> list[float]:
        """Adam over shuffled batches; mean loss per epoch."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            order, seen = r.permutation(len(windows)), []
            for lo in range(0, len(order), batch):
                at = order[lo:lo + batch]
                loss, g = self.loss_and_gradient(windows[at], tags[at])
                seen.append(loss)
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                step += 1
                lr = rate * (1 - epoch / (epochs + 1))
                for k, v in g.items():
                    v = v * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.999 * s[k] + 0.001 * v * v
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses

    def decode(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags (window, place) and the posterior of each."""
        e = self.emissions(windows)[0]
        t, b, _ = e.shape
        move = self.p["move"]
        best, back = e[0], []
        for k in range(1, t):
            x = best[:, :, None] + move
            back.append(x.argmax(1))
            best = np.take_along_axis(x, back[-1][:, None, :], 1)[:, 0] + e[k]
        path = np.empty((t, b), np.int64)
        path[-1] = best.argmax(1)
        for k in range(t - 2, -1, -1):
            path[k] = back[k][np.arange(b), path[k + 1]]
        _, marg, _ = self.posteriors(e)
        sure = np.take_along_axis(marg, path[:, :, None], 2)[:, :, 0]
        return path.T, sure.T


def _plausible(kind: int, text: str) -> bool:
    if kind == 0:
        return "@" in text[1:-1] or bool(_WRITTEN.search(text))
    numbers = _NUMBER.findall(text)
    digits = "".join(numbers)
    if kind == 1:
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    return 13 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def find_spans(texts: list[str], net: Network | None, base: list | None = None) -> list[list[tuple[int, int, int]]]:
    """All spans (kind, start, end) per text, by kind and start: the fixed
    ones (``base``, if known already), and the network's that overlap none of
    them (nor each other). Where a tagged span runs over the edge of what is
    read, the next cell is read too."""
    out = [base_spans(t) for t in texts] if base is None else list(base)
    if net is None:
        return out
    starts = [window_starts(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    if not len(owner):
        return out
    flat = np.concatenate([s for s in starts if len(s)])
    own = slice(STRIDE // 2, STRIDE // 2 + STRIDE)  # the middle that a window decides
    read, seen = [], set()
    new_owner, new = owner, flat
    while len(new):
        cuts = np.append(np.flatnonzero(np.diff(new_owner, prepend=-1)), len(new))
        windows = np.concatenate([_cut(classes(texts[new_owner[lo]]), new[lo:hi]) for lo, hi in zip(cuts, cuts[1:])])
        tags, sure = np.empty((len(new), STRIDE), np.int64), np.empty((len(new), STRIDE), np.float32)
        for lo in range(0, len(windows), 2048):
            t, p = net.decode(windows[lo:lo + 2048])
            tags[lo:lo + 2048], sure[lo:lo + 2048] = t[:, own], p[:, own]
        read.append((new_owner, new, tags, sure))
        seen.update(zip(new_owner.tolist(), new.tolist()))
        before = (tags[:, 0] > 0) & (tags[:, 0] % 2 == 0)  # a further character, so the span begins earlier
        beyond = tags[:, -1] > 0
        more = {(d, s) for open_, step in ((before, -STRIDE), (beyond, STRIDE))
                for d, s in zip(new_owner[open_].tolist(), (new[open_] + step).tolist())
                if 0 <= s + STRIDE // 2 < len(texts[d])} - seen
        new_owner, new = np.array(sorted(more), np.int64).reshape(-1, 2).T
    owner, flat, tags, sure = (np.concatenate(x) for x in zip(*read))
    order = np.lexsort((flat, owner))
    owner, flat, tags, sure = owner[order], flat[order], tags[order], sure[order]
    edge = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
    for lo, hi in zip(edge, edge[1:]):
        d = int(owner[lo])
        place = (flat[lo:hi, None] + np.arange(WINDOW)[own]).ravel()
        got, p = tags[lo:hi].ravel(), sure[lo:hi].ravel()
        out[d] = _merge(texts[d], out[d], place, got, p)
    return out


def _merge(text, base, place, tags, sure):
    taken = sorted((s, e) for _, s, e in base)
    added, n = [], len(tags)
    hot = np.flatnonzero(tags > 0)
    for i in hot.tolist():
        if tags[i] % 2 == 0:
            continue  # not a first character
        kind = int(tags[i] - 1) // 2
        j = i + 1
        while j < n and tags[j] == 2 + 2 * kind and place[j] == place[j - 1] + 1:
            j += 1
        s, e = int(place[i]), int(place[j - 1]) + 1
        if e > len(text) or sure[i:j].min() < CONFIDENCE or not _plausible(kind, text[s:e]):
            continue
        if any(a < e and s < b for a, b in taken):
            continue
        taken.append((s, e))
        added.append((kind, s, e))
    return sorted([*base, *added])


# --- labelled spans beyond the patterns ---------------------------------------------

def _digits(r: random.Random, shape: str) -> str:
    return "".join(str(r.randrange(10)) if c == "9" else c for c in shape)


def _card(r: random.Random, mark: str) -> str:
    d = _digits(r, "9" * 15)
    d += next(c for c in "0123456789" if _luhn(d + c))
    return mark.join(d[i:i + 4] for i in range(0, 16, 4))


def _email(r: random.Random, notation: str, words: list[str]) -> str:
    def name():
        w = r.choice(words) if words and r.random() < 0.5 else "".join(
            r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 10)))
        return w + (_digits(r, "9" * r.randint(1, 3)) if r.random() < 0.2 else "")
    person = name() + (r.choice("._-") + name() if r.random() < 0.4 else "")
    parts = {"n": person, "h": name(), "t": r.choice(("com", "org", "net", "de", "io", "example", "co", "edu"))}
    return re.sub(r"\b[nht]\b", lambda m: parts[m[0]], notation)


def planted(r: random.Random, words: list[str], notations: dict[str, tuple[str, ...]] = NOTATIONS,
            card_marks=CARD_MARKS, ip_marks=IP_MARKS) -> list[tuple[int | None, str]]:
    """(kind or None, text) of one to two values that stand together."""
    case = r.randrange(7)
    if case == 0:
        return [(0, _email(r, r.choice(notations["email"]), words))]
    if case == 1:
        return [(1, r.choice(ip_marks).join(str(r.randrange(256)) for _ in range(4)))]
    if case == 2:
        return [(2, _card(r, r.choice(card_marks)))]
    if case == 3:
        return [(3, _digits(r, r.choice(notations["phone"])))]
    if case == 4:  # run together: too many digits for either pattern
        first = (3, _digits(r, "+9 (999) 999-9999")) if r.random() < 0.5 else (2, _card(r, r.choice(("", " ", "-"))))
        return [first, (2, _card(r, r.choice(("", " "))))]
    if case == 5:
        return [(None, _digits(r, r.choice(OTHER_NUMBERS)))]
    return [(None, "".join(r.choice("0123456789abcdef") for _ in range(r.randint(12, 48))))]


def plant(text: str, r: random.Random, **kinds) -> tuple[str, list[tuple[int, int, int]], int, int]:
    """``text`` with values put between two of its words: the new text, the
    spans planted, and where the planted part starts and ends."""
    gaps = [m.start() for m in re.finditer(" ", text)]
    at = r.choice([0, len(text), *gaps]) if len(gaps) < 3 else r.choice(gaps)
    words = [w for w in re.findall(r"[a-z]{2,10}(?![^ ])", text[max(0, at - 300):at + 300])]
    lead = " " + r.choice(("", "", "", "to ", "tel: ", "via ", "call "))
    new, spans = text[:at] + lead, []
    for kind, value in planted(r, words, **kinds):
        if spans:
            new += " "
        if kind is not None:
            spans.append((kind, len(new), len(new) + len(value)))
        new += value
    end = len(new)
    new += r.choice(("", "", "", ".", ",", ")", "\n"))
    rest = text[at:]
    return new + (rest if not rest or rest[0] == " " else " " + rest), spans, at, end


def _labelled(text: str, spans, starts: np.ndarray) -> set[tuple[bytes, bytes]]:
    if not len(starts):
        return set()
    x, y = classes(text).astype(np.int8), tags_of(len(text), spans)
    return {(a.tobytes(), t.tobytes()) for a, t in zip(_cut(x, starts), _cut(y, starts))}


def pattern_windows(text: str) -> set[tuple[bytes, bytes]]:
    """Windows (classes, tags) labelled by the patterns, but for those with
    text that may be a value in another notation."""
    starts, base = window_starts(text), base_spans(text)
    for m in _DOUBT.finditer(text) if len(starts) else ():
        if not any(s < m.end() and m.start() < e for _, s, e in base):
            starts = starts[(starts >= m.end()) | (starts + WINDOW <= m.start())]
    return _labelled(text, base, starts)


def planted_windows(text: str, times: int) -> set[tuple[bytes, bytes]]:
    """Windows with values planted ``times`` times, each in the text as it
    is; the same ones for the same text."""
    r, out = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass"))), set()
    for _ in range(times):
        new, spans, at, end = plant(text, r)
        lo = max(0, at - 4 * WINDOW)  # only this neighbourhood is labelled and cut
        part = new[lo:end + 4 * WINDOW]
        spans = [(k, s - lo, e - lo) for k, s, e in spans]
        spans += [(k, s, e) for k, s, e in base_spans(part) if not any(a < e and s < b for _, a, b in spans)]
        starts = window_starts(part)
        out |= _labelled(part, spans, starts[(starts < end - lo) & (starts + WINDOW > at - lo)])
    return out


# --- on Spark -----------------------------------------------------------------------

def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: int = TRAIN_WINDOWS,
          planted: int = PLANTED_WINDOWS, look_at: int = TRAIN_DOCS) -> Network | None:
    """A network trained on a bounded sample: at most ``windows`` windows
    labelled by the fixed patterns and at most ``planted`` windows with
    planted values, of about ``look_at`` documents chosen by id hash. None
    if there are no such windows."""
    d = id_and_text(docs, id_col, text_col)
    n = d.count()
    every = max(1, n // look_at)
    times = -(-planted * every // max(1, n))
    some = d.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)

    def cut(windows_of):
        def run(batches):
            for b in batches:
                rows = set().union(*map(windows_of, b.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                                  pa.array([r[1] for r in rows], pa.binary())], ["x", "y"])
        return some.mapInArrow(run, "x binary, y binary").distinct().orderBy(F.xxhash64("x", "y"), "x", "y")
    rows = cut(pattern_windows).limit(windows).collect()
    rows += cut(lambda t: planted_windows(t, times) if t.strip() else set()).limit(planted).collect()
    if not rows:
        return None
    x = np.stack([np.frombuffer(r[0], np.int8) for r in rows]).astype(np.int64)
    y = np.stack([np.frombuffer(r[1], np.int8) for r in rows]).astype(np.int64)
    net = Network.initial()
    net.fit(x, y)
    return net


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


SPANS = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
         "base_sha256 string, spans string")


def detect(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per kind over all spans, ``base_sha256``
    (of the fixed spans) and ``spans`` (kind:start:end in code points, joined
    by commas, by kind and start). NULL and blank texts have none."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                part = texts[lo:hi]
                fixed = [base_spans(t) for t in part]
                spans = find_spans(part, held.value, fixed)
                base = [hashlib.sha256(_join(x).encode()).hexdigest() for x in fixed]
                counts = [[sum(k == kind for k, _, _ in s) for s in spans] for kind in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array(base), pa.array([_join(s) for s in spans])],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, SPANS)


def redact(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind in
    brackets (``[EMAIL]``); all columns stay, NULL texts stay NULL."""
    from racelake.llm.common import ship_package

    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            spans = find_spans([t or "" for t in texts], held.value)
            new = pa.array([_replace(t, s) for t, s in zip(texts, spans)], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)
    return docs.mapInArrow(run, docs.schema)


def _replace(text, spans):
    if not spans:
        return text
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: x[1:]):
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])
