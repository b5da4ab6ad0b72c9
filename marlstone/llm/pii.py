"""Personal data in whole texts: fixed base patterns, and a semi-Markov conditional random field that adds spans.

Base spans (email, ip, card, phone) are found left to right per kind; a match that fails its check is dropped and the
search goes on behind it. The field scores whole candidate segments between the base spans by what the segment
as a whole looks like (digits, separators, shape, cue word to the left, what stands next to either end). Candidates of a
kind are all starts and, for each, all ends its pattern allows between separators, so they overlap, and a dynamic program
over the whole text chooses boundaries and types together, as many as there are; segments it chooses are added, those of
the base stay. It looks for what the base patterns miss: phones without +, emails written with "at" and "dot" or
broken up by blanks, cards with other separators, and base phones that the greedy pattern lost in numbers behind them.
Its weights are trained here by likelihood on examples drawn
by a seeded generator (TRAIN_ROWS of them), so no document is needed and every run has the same model.

Null texts are empty and have no spans; each row is handled alone, so repeated rows, null ids and empty tables
change nothing. A start has a bounded number of ends and the program sorts them, so work is n log n in the text at most.
"""

from __future__ import annotations

import bisect
import functools
import math
import random
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import table

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 600
#: Log-odds a chosen segment must reach over no segment.
MARGIN = 2.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """What a leftmost search of the email pattern finds, from each @ back and forth: linear for any text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        i = at
        while i > done and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at) if i < at else None
        if m:
            out.append((i, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _byte(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    d = digits.lstrip("0")
    return len(d) < 3 or len(d) == 3 and d <= "255"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in _emails(text)]
    if text.count(".") >= 3:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() <= 64 else ""
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# --- candidates and features of the field

_AT = re.compile(r"\s?@\s?|\s?[\[({]\s?at\s?[\])}]\s?|\sat(?=\s)")
_DOT = re.compile(r"\s?\.\s?|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_NUMBER = re.compile(r"[0-9]+")
_CARD_GAP = re.compile(r"[ ./_-]{1,2}")
_PHONE_GAP = re.compile(r"\)?[ ./-]{1,2}\(?")
_IP_GAP = re.compile(r"\s?\[?\.\]?\s?|\s?\[dot\]\s?")
#: Fixed cue words by kind.
CUES = {
    "email": ("email", "mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "address", "server", "ping"),
    "card": ("card", "visa", "credit", "payment", "mastercard"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
}
_WORD = re.compile(r"[A-Za-z]+")


def _alnum(c: str) -> bool:
    return c.isascii() and c.isalnum()


def _email_candidates(text: str, edges: list[int]) -> list[tuple[int, int]]:
    """From each "at": every start in the local part and every end in the domain that follows, 1 to 3 dots in."""
    out = []
    for at in _at_places(text):
        ends, here = [], at.end()
        if text[here : here + 1].isspace() and not text[here - 1].isspace():
            here += 1  # the blank that ends the word "at"; the next "at" may begin with it
        for part in range(4):
            label = _LABEL.match(text, here)
            if not label or (label.end() - here > (20 if part else 40) and "-" not in label[0]):
                break
            if part:
                cuts = [label.end(), *(here + k for k, c in enumerate(label[0]) if c == "-")]
                ends += [b for b in cuts if 2 <= b - here <= 20 and not _alnum(text[b : b + 1])]
            dot = _DOT.match(text, label.end()) if label.end() - here <= (20 if part else 40) else None
            if not dot:
                break
            here = dot.end()
        if not ends:
            continue
        edge = edges[bisect.bisect_right(edges, at.start()) - 1]
        low = max(at.start() - 40, edge)
        for a in range(at.start() - 1, low - 1, -1):
            if text[a] not in _LOCAL:
                break
            before = text[a - 1 : a]
            if a == edge or not _alnum(before) and (_alnum(text[a]) or before not in _LOCAL or not before):
                out += [(a, b) for b in ends]
    return out


def _at_places(text: str) -> list[re.Match]:
    return [m for m in _AT.finditer(text) if m.start() > 0 and text[m.start() - 1] in _LOCAL] if "@" in text or "at" in text else []


def _chains(text: str, runs: list[re.Match], gap: re.Pattern) -> list[int]:
    """For each run of digits how many runs, itself included, follow each other with such gaps between."""
    length = [1] * len(runs)
    for i in range(len(runs) - 2, -1, -1):
        if runs[i + 1].start() - runs[i].end() <= 7 and gap.fullmatch(text, runs[i].end(), runs[i + 1].start()):
            length[i] = length[i + 1] + 1
    return length


def _number_candidates(text: str) -> list[tuple[str, int, int]]:
    out = []
    runs = list(_NUMBER.finditer(text))
    if len(runs) < 3:
        return out
    size = [m.end() - m.start() for m in runs]
    cards, phones, ips = (_chains(text, runs, g) for g in (_CARD_GAP, _PHONE_GAP, _IP_GAP))
    for i, m in enumerate(runs):
        a = m.start()
        free = not _alnum(text[a - 1 : a])
        if free and size[i] == 4:
            for k in range(i + 1, min(i + 5, i + cards[i])):
                if not 3 <= size[k] <= 6:
                    break
                if k >= i + 2 and not _alnum(text[runs[k].end() : runs[k].end() + 1]):
                    out.append(("card", a, runs[k].end()))
        if free and ips[i] >= 4 and max(size[i : i + 4]) <= 3 and not _alnum(text[runs[i + 3].end() : runs[i + 3].end() + 1]):
            out.append(("ip", a, runs[i + 3].end()))
        for start, first, length in _phone_starts(text, runs, size, phones, i):
            for k in range(first, min(first + 5, first + phones[first])):
                if not 2 <= (length if k == first else size[k]) <= 4:
                    break
                b = runs[k].end()
                if k >= first + 2:
                    out += [("phone", start, e) for e in ((b, b + 1) if text[b : b + 1] == ")" else (b,)) if not _alnum(text[e : e + 1])]
    return out


def _phone_starts(text: str, runs: list[re.Match], size: list[int], phones: list[int], i: int) -> list[tuple[int, int, int]]:
    """(start, index of the first group, its length) of each way a phone number begins with this run."""
    a = runs[i].start()
    out = [(a, i, size[i])]
    if text[a - 1 : a] == "(":
        out.append((a - 1, i, size[i]))
    if size[i] > 2 and runs[i][0].startswith("00"):
        out.append((a, i, size[i] - 2))
    # 00 as a group of its own before this one: one blank or hyphen, or a bracket between
    if i and runs[i - 1][0] == "00" and text[runs[i - 1].end() : a] in (" ", "-", " (", "-(", "("):
        out.append((runs[i - 1].start(), i, size[i]))
    # + and a country code before this one, where the base pattern ran on into other numbers
    if i and size[i - 1] <= 3 and text[runs[i - 1].start() - 1 : runs[i - 1].start()] == "+" and text[runs[i - 1].end() : a] in (" ", "-", " (", "-(", "("):
        out.append((runs[i - 1].start() - 1, i, size[i]))
    for plus in ("+ ", "+ ("):
        if text[max(0, a - len(plus)) : a] == plus:
            out.append((a - len(plus), i, size[i]))
    return [(s, k, n) for s, k, n in out if not _alnum(text[s - 1 : s])]


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Every segment of each kind that meets none of the taken spans."""
    begins, ends = [], []
    for a, b in sorted(taken):
        if ends and a < ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            begins.append(a)
            ends.append(b)
    found = [("email", *s) for s in _email_candidates(text, [0, *ends])] + _number_candidates(text)
    out = set()
    for kind, a, b in found:
        k = bisect.bisect_right(ends, a)
        if k == len(ends) or begins[k] >= b:
            out.add((kind, a, b))
    return sorted(out, key=lambda c: (c[1], c[2], c[0]))


_GROUP_BEFORE = re.compile(r"[0-9]\)?[ ./_-]{1,2}\(?$")
_GROUP_AFTER = re.compile(r"\)?[ ./_-]{1,2}\(?[0-9]")


def _beside(text: str, kind: str, a: int, b: int) -> tuple[str, str]:
    """What stands left and right of a segment: blank, more of the same, the end of a sentence, other."""
    left, right = text[max(0, a - 4) : a], text[b : b + 4]
    if kind == "email":
        before = "more" if left and left[-1] in _LOCAL else "blank" if not left or left[-1].isspace() else "other"
        after = "more" if re.match(r"[.-][A-Za-z0-9]|\s?[\[({]\s?d", right) else "stop" if re.match(r"[.!?](\s|$)", right) else "blank" if not right or right[0].isspace() else "other"
        return before, after
    before = "open" if left.endswith("(") else "more" if _GROUP_BEFORE.search(left) else "blank" if not left or left[-1].isspace() else "other"
    after = "close" if right.startswith(")") else "more" if _GROUP_AFTER.match(right) else "stop" if re.match(r"[.!?](\s|$)", right) else "blank" if not right or right[0].isspace() else "other"
    return before, after


def features(text: str, kind: str, a: int, b: int) -> list[str]:
    s = text[a:b]
    d = _digits(s)
    cue = {w.lower() for w in _WORD.findall(text[max(0, a - 30) : a])}
    out = [f"{kind}:bias", f"{kind}:digits={min(len(d), 20)}", f"{kind}:seps={''.join(sorted({c for c in s if not c.isalnum()}))[:6]}"]
    groups = re.findall(r"[0-9]+", s)
    out.append(f"{kind}:shape={'-'.join(str(len(g)) for g in groups)[:24]}" if kind in ("card", "phone") else f"{kind}:parts={min(len(groups), 6)}")
    if kind == "card":
        out.append(f"card:luhn={luhn(d)}")
    if kind == "phone":
        out.append(f"phone:open={s[0] if s[0] in '(+0' else 'd'}")
        out.append(f"phone:date={bool(re.fullmatch(r'(19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}', s))}")
    if kind == "ip":
        out.append(f"ip:range={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if kind == "email":
        out.append(f"email:at={'@' if '@' in s else ('bracket' if re.search(r'[(\[{]', s) else 'word')}")
        out.append(f"email:dot={'word' if re.search(r'dot', s) else 'sign'}")
        dots = {m[0] for m in re.finditer(r"\s?\.\s?|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s", s[re.search(r"@|at(?![A-Za-z0-9])", s).end() :])}
        out.append(f"email:dots={'|'.join(sorted(dots))}")
        last = re.search(r"[A-Za-z0-9-]+$", s)[0]
        out.append(f"email:last={'lower' if last.islower() and last.isalpha() else 'other'}{min(len(last), 5)}")
    before, after = _beside(text, kind, a, b)
    out += [f"{kind}:left={before}", f"{kind}:right={after}"]
    if cue & set(CUES[kind]):
        out.append(f"{kind}:cue")
    return out


def _meet(segs: list[tuple[float, str, int, int]]) -> list[int]:
    """Of segments in order of their ends: how many end before each one starts."""
    ends = [s[3] for s in segs]
    return [bisect.bisect_right(ends, s[2]) for s in segs]


def best_segments(scored: list[tuple[float, str, int, int]]) -> list[tuple[str, int, int]]:
    """Non-overlapping segments of the greatest total score."""
    segs = sorted(scored, key=lambda s: (s[3], s[2], s[1]))
    before = _meet(segs)
    best = [0.0]
    for s, j in zip(segs, before):
        best.append(max(best[-1], best[j] + s[0]))
    out, i = [], len(segs)
    while i:
        if best[i] > best[i - 1]:
            out.append(segs[i - 1][1:])
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def _add(x: float, y: float) -> float:
    m = max(x, y)
    return m + math.log(math.exp(x - m) + math.exp(y - m))


def _partition(scored: list[tuple[float, str, int, int]]) -> tuple[float, list[float]]:
    """log Z of all sets of non-overlapping segments, and each segment's probability."""
    order = sorted(range(len(scored)), key=lambda i: (scored[i][3], scored[i][2]))
    ends = [scored[i][3] for i in order]
    fore = [0.0]
    for k in order:
        fore.append(_add(fore[-1], fore[bisect.bisect_right(ends, scored[k][2])] + scored[k][0]))
    order = sorted(range(len(scored)), key=lambda i: -scored[i][2])
    starts = [-scored[i][2] for i in order]
    back = [0.0]
    for k in order:
        back.append(_add(back[-1], back[bisect.bisect_right(starts, -scored[k][3])] + scored[k][0]))
    z = fore[-1]
    return z, [math.exp(min(0.0, fore[bisect.bisect_right(ends, a)] + w + back[bisect.bisect_right(starts, -b)] - z)) for w, _, a, b in scored]


# --- training

_FILL = "the of and que der und les una one more item order page total code time version unit".split()


def _entity(r: random.Random, kind: str) -> str:
    """An entity of this kind written as the base patterns miss it."""
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    if kind == "phone":
        sep = r.choice(" -./")
        return r.choice((f"({digits(3)}) {digits(3)}{r.choice(' -')}{digits(4)}", f"{digits(3)}{sep}{digits(3)}{sep}{digits(4)}", f"00{digits(2)} {digits(3)} {digits(3)} {digits(3)}"))
    if kind == "email":
        name, host = r.choice(("ana", "jo.lee", "max_19", "sam")), r.choice(("mail", "example", "corp"))
        return r.choice((f"{name} [at] {host} [dot] com", f"{name} at {host} dot org", f"{name}(at){host}.com", f"{name} [at] {host}.com", f"{name} @ {host}.net"))
    if kind == "card":
        d = "4" + digits(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return r.choice(("_", "/", ".", "  ")).join(d[k : k + 4] for k in (0, 4, 8, 12))
    p = [str(r.randrange(256)) for _ in range(4)]
    return r.choice((f"{p[0]}[.]{p[1]}[.]{p[2]}[.]{p[3]}", " . ".join(p), " [.] ".join(p), f"{p[0]}[dot]{p[1]}[dot]{p[2]}[dot]{p[3]}"))


def _example(r: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A line with entities written as the base patterns miss them, one or two side by side, or with numbers that are none."""
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: r.choice(_FILL)
    kind = r.choice((*KINDS, "none", "none", "none"))
    text = " ".join(word() for _ in range(r.randrange(1, 5)))
    gold = []
    if kind == "none":
        text += " " + r.choice((f"20{digits(2)}-0{digits(1)[0]}-1{digits(1)}", f"{digits(2)}/{digits(2)}/20{digits(2)}", f"{digits(2)} {digits(2)} {digits(2)}", f"{digits(3)} . {digits(3)} . 9{digits(2)} . {digits(3)}", f"{digits(4)} {digits(4)} {digits(3)} {digits(5)}", f"{word()} at {word()} . {word()}", f"{word()} at {word()}. {word().title()} {word()}", f"look at it . {word()}", f"{digits(4)}-{digits(4)}", f"{digits(2)}.{digits(2)}.{digits(4)}", f"{digits(3)}-{digits(2)}-{digits(4)} {digits(2)}"))
    else:
        if r.random() < 0.4:
            text += " " + r.choice(CUES[kind])
        if kind == "phone" and r.random() < 0.2:
            # a base phone that the greedy pattern loses in the address behind it
            s = f"+{r.randrange(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}"
            gold.append((kind, len(text) + 1, len(text) + 1 + len(s)))
            return f"{text} {s} {'.'.join(str(r.randrange(100, 256)) for _ in range(4))} {word()}", gold
        for k in (kind,) if r.random() < 0.6 else (kind, kind) if r.random() < 0.7 else (kind, r.choice(KINDS)):
            text += r.choice((" ", " ", ", ")) if gold else " "
            s = _entity(r, k)
            gold.append((k, len(text), len(text) + len(s)))
            text += s
    tail = " ".join(word() for _ in range(3))
    return text + (f". {tail.capitalize()}" if r.random() < 0.3 else f" {tail}"), gold


@functools.cache
def weights(seed: int = 11, epochs: int = 12, rate: float = 0.3, decay: float = 0.002) -> dict[str, float]:
    """Weights of the field by stochastic gradient steps on the log-likelihood of the examples' segmentations."""
    r = random.Random(seed)
    data = []
    for _ in range(TRAIN_ROWS):
        text, gold = _example(r)
        segs = candidates(text, [(a, b) for _, a, b in base_spans(text)])
        data.append(([features(text, *s) for s in segs], segs, set(gold)))
    w: dict[str, float] = {}
    for _ in range(epochs):
        r.shuffle(data)
        for feats, segs, gold in data:
            scored = [(sum(w.get(f, 0.0) for f in fs), *s) for fs, s in zip(feats, segs)]
            _, p = _partition(scored)
            for fs, s, prob in zip(feats, segs, p):
                step = rate * ((s in gold) - prob)
                for f in fs:
                    w[f] = w.get(f, 0.0) * (1 - decay) + step
    return w


def added_spans(text: str, base: list[tuple[str, int, int]], w: dict[str, float]) -> list[tuple[str, int, int]]:
    found = candidates(text, [(a, b) for _, a, b in base])
    # features never met in training count as evidence against the segment
    scored = [(sum(w.get(f, -0.5) for f in features(text, *s)) - MARGIN, *s) for s in found]
    return best_segments([s for s in scored if s[0] > 0])


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def find(text: Column) -> Column:
    """struct<base string, spans string> of a text column: kind:start:end by start and kind, comma-joined."""
    w = weights()

    @F.pandas_udf("base string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            t = t if isinstance(t, str) else ""
            base = base_spans(t)
            rows.append((join_spans(base), join_spans(base + added_spans(t, base, w))))
        return pd.DataFrame(rows, columns=["base", "spans"])

    return run(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", find(F.col("text")).alias("p"))
    count = lambda k: F.size(F.filter(F.split("p.base", ","), lambda s: s.startswith(f"{k}:"))).cast("long").alias(f"n_{k}")
    total = F.size(F.filter(F.split("p.spans", ","), lambda s: s != "")).cast("long").alias("n_spans")  # base and added
    return d.select("doc_id", *[count(k) for k in KINDS], F.sha2("p.base", 256).alias("base_sha256"), F.col("p.spans").alias("spans"), total)
