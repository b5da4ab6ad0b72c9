"""The base patterns against plain regexes, and the field on lines of a generator that has nothing in common with the one it learns from."""

import random
import re
import time

from marlstone.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_patterns():
    r = random.Random(2)
    parts = ["@", ".", "+", "-", " ", "(", ")", "a", "b.c", "x@y.z", "1", "25", "255", "256", "007", "4465 7583 8288 9437", "+1 555", "%", "é", "\n", "1.2.3.4", "0"]
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 24)))
        assert pii.base_spans(t) == _plain(t), t


def test_long_runs():
    """Numbers beyond what int() takes, and time that grows with the text, not with its square."""
    assert pii.base_spans("0" * 5000 + "1.1.1.1") == [("ip", 0, 5007)] and pii.base_spans("9" * 5000 + ".1.1.1") == []
    w, took = pii.weights(), []
    for n in (2000, 8000):
        for unit in ("a@b.co 10.0.0.1 743 555 3824 sam at corp . com ", "743 ", "a@", "+1 (", "at at "):
            text = unit * (n * 40 // len(unit))
            began = time.process_time()
            pii.added_spans(text, pii.base_spans(text), w)
            took.append(time.process_time() - began)
    half = len(took) // 2
    assert all(b < 10 * a + 1 for a, b in zip(took[:half], took[half:]))


def _luhn_number(r):
    d = [5, r.randrange(1, 6), *(r.randrange(10) for _ in range(13))]
    for last in range(10):
        if sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed([*d, last]))) % 10 == 0:
            return "".join(map(str, [*d, last]))


def held_out(r):
    """A line of another generator: other words, names, hosts and sentence frames; entities, look-alikes or neither."""
    n = lambda k: "".join(str(r.randrange(10)) for _ in range(k))
    area = f"{r.randrange(2, 10)}{n(2)}"
    make = {
        "phone": lambda: r.choice((f"({area}) {n(3)}-{n(4)}", f"{area}.{n(3)}.{n(4)}", f"{area} {n(3)} {n(4)}", f"{area}-{n(3)}-{n(4)}", f"0033 {n(3)} {n(3)} {n(3)}")),
        "email": lambda: "{} {} {}".format(r.choice(("peter", "li_wei", "k.novak", "info77")), r.choice(("[at]", "at", "(at)", "@")), r.choice(("firma", "uni-x", "posten"))) + r.choice((" [dot] ", " dot ", ".")) + r.choice(("de", "net", "org")),
        "card": lambda: (lambda d, s: s.join((d[:4], d[4:8], d[8:12], d[12:])))(_luhn_number(r), r.choice("_./")),
        "ip": lambda: r.choice((" . ", "[.]", "[dot]", " [.] ")).join(str(r.randrange(256)) for _ in range(4)),
    }
    decoy = (lambda: f"{r.randrange(1, 29)}.{r.randrange(1, 13)}.{r.randrange(1950, 2030)}", lambda: f"{r.randrange(1990, 2030)}-{r.randrange(10, 13)}-{r.randrange(10, 29)}", lambda: f"chapter {n(1)}.{n(1)}", lambda: f"{n(4)} {n(4)}", lambda: "we met at noon . Then", lambda: f"room {n(3)} at 7", lambda: f"score {n(2)} to {n(2)}", lambda: f"isbn {n(3)}-{n(1)}-{n(4)}")
    words = "river stone kalt gestern pour avec mesa libro window chair green march".split()
    text, gold = "", []
    for _ in range(r.randrange(1, 4)):
        text += " ".join(r.choice(words) for _ in range(r.randrange(2, 6))) + r.choice((" ", ": ", ", "))
        if r.random() < 0.5:
            kind = r.choice(list(make))
            s = make[kind]()
            gold.append((kind, len(text), len(text) + len(s)))
        else:
            s = r.choice(decoy)()
        text += s + r.choice((" ", ". ", ", ", "; "))
    return text + "end", gold


def scores(lines=2000, seed=77):
    """(recall, precision) of exact spans with their kind, base and added, on held-out lines."""
    r, w = random.Random(seed), pii.weights()
    hit = found = true = 0
    for _ in range(lines):
        text, gold = held_out(r)
        base = pii.base_spans(text)
        got = {*base, *pii.added_spans(text, base, w)}
        hit, found, true = hit + len(got & set(gold)), found + len(got), true + len(gold)
    return hit / true, hit / found


def test_held_out_lines():
    recall, precision = scores()
    assert recall >= 0.85 and precision >= 0.9, (recall, precision)


def test_phone_before_address():
    text = "Des +1 (826) 555-4081 190.137.2.6 fin"
    assert [k for k, *_ in pii.base_spans(text)] == ["ip"]
    assert ("phone", 4, 21) in pii.added_spans(text, pii.base_spans(text), pii.weights())
