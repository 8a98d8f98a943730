"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens for what they miss.

The field tags tokens as begin, inside or outside of a secret. Features are a token's shape (length, character kinds and
changes between them, entropy), the words and marks before and after it, and features of the text (share of digits,
assignments on the line). It is trained here, by gradient ascent on the conditional log-likelihood with forward-backward,
on generated lines: secrets of many forms in many contexts, and what looks like them but isn't - numbers, dates, links,
file names, identifiers, long words.

Decoding is Viterbi with one constraint: only the tokens of a stretch that could hold a secret may begin or continue one,
words, short pieces and marks alike, and a secret doesn't continue from one stretch to the next. A stretch is MIN_LENGTH or more
printable ASCII characters without white space and quotes; it could hold a secret if it has a letter, and a digit, a capital
after a small letter, : or = in or before it, or a secret's name (key, token, ...) before it (see possible()). All other tokens are outside with certainty, which parts the
chain; so decoding only the lines' parts around such stretches gives exactly the best tagging of the whole text, in time that
follows the number of their tokens. The field so never finds secrets under MIN_LENGTH characters between spaces or quotes, ones
of several words (of which each long one may be found), parts that aren't ASCII, and all-digit words, or one-case words
without any of these before them.
"""

from __future__ import annotations

import functools
import itertools
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")
MIN_LENGTH = 12
TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]+|[^\sA-Za-z0-9+/_=.-]")
STRETCH = re.compile(r"[!#-&(-_a-~]{%d,}" % MIN_LENGTH)
_GIVEN = re.compile(r"""(?:[:=]|(?i:key|token|secret|passwor[dt]|passwd|pwd|phrase|credentials?|auth|bearer)(?:\x20is)?)\x20{0,2}["'`]?$""")
_RUN, _LETTER, _LIKELY = re.compile("[a-z]+"), re.compile("[A-Za-z]"), re.compile("[0-9:=]|[a-z][A-Z]")
OUT, BEGIN, INSIDE = 0, 1, 2
#: Characters on either side of a candidate that its features may look at.
REACH = 60
_WORD = re.compile(r"[A-Za-z_]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping within a kind, by start and kind."""
    out = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def possible(stretch: str, given: bool = False) -> bool:
    """Whether a stretch could hold a secret; given: : or = or a secret's name stands right before it."""
    return len(stretch) >= MIN_LENGTH and _LETTER.search(stretch) is not None and (given or _LIKELY.search(stretch) is not None)


def stretches(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in STRETCH.finditer(text) if possible(m[0]) or possible(m[0], _GIVEN.search(text, max(0, m.start() - 18), m.start()) is not None)]


def chain(text: str, found: list[tuple[int, int]], low: int = 0, high: int | None = None) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Spans of the tokens of text[low:high], and for each stretch the range of its tokens."""
    spans = [m.span() for m in TOKEN.finditer(text, low, len(text) if high is None else high)]
    starts = [a for a, _ in spans]
    return spans, [(bisect_left(starts, a), bisect_left(starts, b)) for a, b in found]


_NAMED = re.compile(r"key|secret|passw|token|auth|cred|bearer|private|pwd")


def stretch_features(tokens: list[str], first: int, end: int) -> list[str]:
    """Features of a stretch of several tokens, which all of them share."""
    x = "".join(tokens[first:end])
    n, count = len(x), Counter(x)
    kinds = "".join("aA0."[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3] for c in x)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    entropy = -sum(m / n * math.log2(m / n) for m in count.values())
    marks = [t for t in tokens[first:end] if not (t[0].isalnum() or t[0] in "+/_=.-")]
    before = [t.lower() for t in tokens[max(0, first - 4) : first]]
    out = ["several", f"slen{min(n, 64) // 4}", f"schg{min(8, 16 * changes // n)}", f"sent{int(entropy * 2)}", f"sdig{int(8 * kinds.count('0') / n)}", f"shas{('a' in kinds) + 2 * ('A' in kinds) + 4 * ('0' in kinds)}"]
    out += [f"smarks{min(6, len(marks))}", f"srun{min(10, max(map(len, _RUN.findall(x)), default=0))}", *(f"shas={m}" for m in set(marks))]
    out += [name for name, yes in (("surl", "://" in x or "www." in x), ("smail", re.search(r"@[A-Za-z0-9-]+\.", x)), ("snamed", any(map(_NAMED.search, before))), ("sgiven", {"=", ":"} & {*before[-2:]})) if yes]
    return out


def features(tokens: list[str], i: int, share_digits: float, part: tuple[int, int] | None = None, shared: list[str] | None = None) -> list[str]:
    """Features of a token; of one in a stretch of several tokens (part), with those of the stretch and its place there."""
    x = tokens[i]
    low, up, num = sum("a" <= c <= "z" for c in x), sum("A" <= c <= "Z" for c in x), sum("0" <= c <= "9" for c in x)
    kinds = "".join("aA0."[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3] for c in x)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    n = max(len(x), 1)
    entropy = -sum(m / n * math.log2(m / n) for m in Counter(x).values())
    out = ["1", f"len{min(n, 48) // 4}", f"chg{min(8, 16 * changes // n)}", f"ent{int(entropy * 2)}", f"dig{int(8 * num / n)}", f"has{(low > 0) + 2 * (up > 0) + 4 * (num > 0)}", f"dots{min(3, x.count('.'))}", f"dash{min(5, x.count('-'))}", f"slash{min(3, x.count('/'))}"]
    if re.fullmatch(r"[0-9]+([-./][0-9]+)*", x):
        out.append("number")
    if re.search(r"[A-Za-z]{7,}", x):
        out.append("wordy")
    if re.search(r"\.(com|org|net|html?|json|txt|py|csv|log|gz|zip|png|jpe?g)\b", x):
        out.append("file")
    before = [t.lower() for t in tokens[max(0, i - 4) : i]]
    after = [t.lower() for t in tokens[i + 1 : i + 3]]
    out += [f"b{k}={t[:16]}" for k, t in enumerate(reversed(before), 1)] + [f"a{k}={t[:16]}" for k, t in enumerate(after, 1)]
    if any(map(_NAMED.search, before)):
        out.append("named")
    if {"=", ":"} & {*before[-2:]}:
        out.append("given")
    out.append(f"text{int(8 * share_digits)}")
    if part is None or part[1] - part[0] < 2:
        return out + ["plain"] if not num else out
    first, end = part
    own = x if len(x) == 1 else "w"
    left, right = (tokens[k] if first <= k < end and len(tokens[k]) == 1 else "w" if first <= k < end else "|" for k in (i - 1, i + 1))
    out += shared + [f"own={own}", f"left={left}", f"right={right}", f"left={left}{own}", f"right={own}{right}"]
    if all(not (t[0].isalnum() or t[0] in "+/_=.-") for t in tokens[i:end]):
        out.append(f"tail={own}")
    if all(not (t[0].isalnum() or t[0] in "+/_=.-") for t in tokens[first : i + 1]):
        out.append(f"head={own}")
    return out


def _lines(n: int, seed: int, marks: bool) -> list[tuple[str, tuple[int, int] | None]]:
    """Generated lines with the place of the secret, if there is one. With marks, most values are stretches of several tokens,
    and some secrets are letters only."""
    r = random.Random(seed)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    pick = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))

    def word():
        return "".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar"]) for _ in range(r.randint(1, 7)))

    def secret():
        x = r.choice([lambda: pick(alnum, 16, 44), lambda: pick(alnum + "+/", 24, 60) + r.choice(["", "=", "=="]), lambda: r.choice(["sk_live_", "ghp_", "xoxb-", "AIza", "pk_test_", "glpat-"]) + pick(alnum, 16, 36), lambda: ".".join(["eyJ" + pick(alnum, 14, 30), pick(alnum, 14, 40), pick(alnum + "_-", 14, 40)]), lambda: pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 24)])()
        return x if has_both(x) else secret()

    has_both = lambda x: len(x) >= MIN_LENGTH and re.search("[0-9]", x) and re.search("[A-Za-z]", x)
    letters, odd = alnum[:52], "$!@#%^&*~?|$!@#%&*"

    def marked():
        def pieces():
            return "".join(pick(alnum + "-_.", 1, 12) + pick(odd, 1, 2) for _ in range(r.randint(1, 4))) + pick(alnum, 2, 10)

        def like_words():
            swap = str.maketrans("aosie", "@0$1" + r.choice("3!"))
            return (word() + word()).title().translate(swap) + r.choice(["-", "_", "!", "#", ".", "$", ""]) + word() + str(r.randint(1, 9999))

        x = r.choice([pieces, pieces, like_words, lambda: pick(alnum + odd, 14, 40), lambda: pick(letters, 16, 40), lambda: pick(letters[:26], 14, 32), secret])() + r.choice(["", "", "", "!", "$", "#", "*"])
        return x if STRETCH.fullmatch(x) else marked()

    def harmless_marked():
        return r.choice([
            lambda: f"http{r.choice(['', 's'])}://{r.choice(['www.', ''])}{word()}.{r.choice(['com', 'org', 'net'])}/{word()}/{r.randint(1, 9999)}?{word()}={r.randint(1, 999)}&{word()}={word()}", lambda: f"{word()}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com", lambda: f"{word()}@{word()}.org",
            lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}:{r.randint(0, 59):02d}:{r.randint(0, 59):02d}Z", lambda: f"{word()}({word()}_{r.randint(0, 99)},{word()})", lambda: f"{word()},{word()};{word()}{r.randint(0, 99)}", lambda: f"**{word()}{word()}{r.randint(0, 99)}**", lambda: f"{word()}#{r.randint(1, 99999)}|{word()}|{word()}",
            lambda: f"(${r.randint(1, 999)},{r.randint(100, 999)}.{r.randint(10, 99)}USD)", lambda: f"<{word()}>{word()}{r.randint(0, 9)}</{word()}>", lambda: word() + word().title() + word().title() + word().title(), lambda: word() + word() + word() + word(), lambda: f"[{word()}{r.randint(1, 99)}]({word()}/{word()}.html)", lambda: f"{{{word()}:{r.randint(1, 99999)},{word()}:{word()}}}",
            lambda: f"{word()}{word()}:{r.randint(1, 99)}:{word()}", lambda: f"#{word()}{word()}{r.randint(1, 2030)}!", lambda: f"{word()}&{word()}%{r.randint(1, 99)}{word()}", lambda: " ".join([word() + word() + word() + r.choice(",.:;!?)")] * 1), lambda: f"{word()}###%%{word()}", lambda: f"~/{word()}/{word()}_{r.randint(1, 99)}.{r.choice(['txt', 'log', 'csv'])}:{r.randint(1, 999)}", harmless,
        ])()

    def harmless():
        return r.choice([
            lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}", lambda: word() + word() + str(r.randint(0, 9999)), lambda: "www." + word() + ".com/" + word() + "/" + str(r.randint(1, 99999)),
            lambda: f"{word()}_{word()}_{r.randint(0, 99)}.{r.choice(['txt', 'json', 'py', 'html', 'csv'])}", lambda: "/".join([word(), word(), f"v{r.randint(1, 9)}", word()]), lambda: str(r.randint(10**11, 10**16)), lambda: f"{word()}-{word()}-{r.randint(1, 999)}-{word()}",
            lambda: f"{word()}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com".replace("@", ""), lambda: f"{pick('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 2, 4)}-{r.randint(1000, 9999999)}-{r.randint(1, 99)}", lambda: f"{r.randint(1, 255)}.{r.randint(1, 255)}.{r.randint(1, 255)}.{r.randint(1, 255)}:{r.randint(1, 9999)}", lambda: "version-" + ".".join(str(r.randint(0, 30)) for _ in range(4)), lambda: word() + word() + word(), lambda: f"ISBN{r.randint(10**12, 10**13)}",
        ])()

    named = ["api-key", "apikey", "access key", "client_secret", "auth", "Authorization: Bearer", "private key", "credentials", "pwd", "passphrase", "aws_secret_access_key", "session key", "secret key", "auth_token", "bearer"]
    other = ["id", "see", "file", "version", "date", "path", "ref", "page", "order", "from", "link", "isbn", "build", "name", "at", "commit", "number", "phone"]
    out = []
    for _ in range(n):
        good = r.random() < 0.45
        value = (marked() if marks else secret()) if good else (harmless_marked() if marks else harmless())
        before = after = ""
        if marks and r.random() < 0.12:  # an address, of which at most the part after a user's name is secret
            host = f"{word()}{r.choice(['', r.randint(1, 9)])}.{word()}.{r.choice(['com', 'net', 'internal'])}"
            scheme, end = r.choice(["postgres", "mysql", "mongodb", "redis", "amqp", "https", "ftp", "ssh"]) + "://", r.choice(["", f":{r.randint(20, 9999)}"]) + r.choice(["", f"/{word()}", f"/{word()}_{r.randint(1, 99)}"])
            before, after = (scheme + word() + ":", r.choice(["@" + host + end, "@" + host + end, ""])) if good else (scheme, "")
            value = secret() if good else r.choice([host, word() + "@" + host, host + f":{r.randint(20, 9999)}"]) + end
        label = r.choice(named) if r.random() < (0.9 if good else 0.04) else r.choice(other)
        mid = r.choice([" = ", ": ", "=", " ", " is ", ' = "', ": '"])
        line = " ".join(word() for _ in range(r.randint(0, 8))) + " " + label + mid + before
        tail = ('"' if mid.endswith('"') else "'" if mid.endswith("'") else "") + r.choice(["", " ", ", ", "; "]) + " ".join(word() for _ in range(r.randint(0, 8)))
        out.append((line + value + after + tail, (len(line), len(line) + len(value)) if good else None))
    return out


def _tagged(text: str, at: tuple[int, int] | None) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """Tokens, tags and stretches of a generated line. A label that is one token with its secret is tagged with it."""
    spans, parts = chain(text, stretches(text))
    tags = [OUT] * len(spans)
    for first, end in parts:
        for i in range(first, end):
            if at and spans[i][0] < at[1] and spans[i][1] > at[0]:
                tags[i] = INSIDE if i > first and tags[i - 1] != OUT else BEGIN
    return [text[a:b] for a, b in spans], tags, parts


@functools.lru_cache(1)
def _examples(n: int = 1600, seed: int = 4, marks: bool = False) -> list[tuple[list[str], list[int]]]:
    """Generated lines as (tokens, tags)."""
    return [_tagged(*x)[:2] for x in _lines(n, seed, marks)]


def _allowed(n: int, parts: list[tuple[int, int]]) -> np.ndarray:
    can = np.zeros((n, 3), bool)
    can[:, OUT] = True
    for first, end in parts:
        can[first:end] = True
        can[first, INSIDE] = False
    return can


def _featured(tokens: list[str], parts: list[tuple[int, int]], share: float) -> list[list[str]]:
    """The features of each token; none outside stretches."""
    out = [[] for _ in tokens]
    for part in parts:
        shared = stretch_features(tokens, *part) if part[1] - part[0] > 1 else None
        for i in range(*part):
            out[i] = features(tokens, i, share, part, shared)
    return out


@functools.lru_cache(1)
def trained(rounds: int = 80, rate: float = 0.5, penalty: float = 1e-4) -> dict:
    """{"weights": {feature: three scores}, "step": 3 x 3 scores}: fitted to the generated lines, all at once, by
    Adagrad on the mean log-likelihood."""
    data = []
    names: dict[str, int] = {}
    for tokens, tags, parts in (_tagged(*x) for x in _lines(1600, 4, False) + _lines(3000, 5, True)):
        share = sum(c.isdigit() for t in tokens for c in t) / max(1, sum(map(len, tokens)))
        rows = [[names.setdefault(f, len(names)) for f in found] for found in _featured(tokens, parts, share)]
        data.append((rows, tags, _allowed(len(tokens), parts)))
    longest = max(len(d[1]) for d in data)
    n = len(data)
    owner, feature, y = [], [], np.zeros((n, longest), int)
    can, live = np.zeros((n, longest, 3), bool), np.zeros((n, longest), bool)
    can[:, :, OUT] = True
    for i, (rows, tags, ok) in enumerate(data):
        y[i, : len(tags)], can[i, : len(tags)], live[i, : len(tags)] = tags, ok, True
        for j, row in enumerate(rows):
            owner += [i * longest + j] * len(row)
            feature += row
    owner, feature = np.array(owner), np.array(feature)
    w, step = np.zeros((len(names), 3)), np.zeros((3, 3))
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    gw, gs = np.full_like(w, 1e-8), np.full_like(step, 1e-8)
    barred = np.zeros((3, 3))
    barred[OUT, INSIDE] = -1e9
    pair_y = np.zeros((3, 3))
    both = live[:, 1:]
    np.add.at(pair_y, (y[:, :-1][both], y[:, 1:][both]), 1)
    gold = np.eye(3)[y] * live[:, :, None]
    for _ in range(rounds):
        score = np.zeros((n * longest, 3))
        score[owner[heads]] = np.add.reduceat(w[feature], heads, axis=0)
        score = np.where(can, score.reshape(n, longest, 3), -1e9)
        score[:, 0, INSIDE] = -1e9
        t = step + barred
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for j in range(1, longest):
            alpha[:, j] = score[:, j] + np.logaddexp.reduce(alpha[:, j - 1, :, None] + t, axis=1)
        for j in range(longest - 2, -1, -1):
            beta[:, j] = np.logaddexp.reduce(t + (score[:, j + 1] + beta[:, j + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        prob = np.exp(alpha + beta - z[:, None, None])
        pair = np.exp(alpha[:, :-1, :, None] + t + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        left = (gold - prob * live[:, :, None]).reshape(-1, 3)
        dw = np.stack([np.bincount(feature, left[owner, k], len(names)) for k in range(3)], axis=1)
        dw, ds = dw / n - penalty * w, (pair_y - pair[both].sum(0)) / n - penalty * step
        gw += dw**2
        gs += ds**2
        w += rate * dw / np.sqrt(gw)
        step += rate * ds / np.sqrt(gs)
    return {"weights": {f: w[i].round(6).tolist() for f, i in names.items()}, "step": (step + barred).tolist()}


def viterbi(score: np.ndarray, step: np.ndarray) -> list[int]:
    best, back = score[0].copy(), []
    for row in score[1:]:
        reach = best[:, None] + step
        back.append(reach.argmax(0))
        best = reach.max(0) + row
    tags = [int(best.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def field_spans(text: str, model: dict) -> list[tuple[int, int, str]]:
    """(start, end, "crf") of the runs that the field tags as secrets, from a whole text."""
    groups: list[list[tuple[int, int]]] = []
    for start, end in stretches(text):
        if groups and start - groups[-1][-1][1] <= REACH and text.find("\n", groups[-1][-1][1], start) < 0:
            groups[-1].append((start, end))
        else:
            groups.append([(start, end)])
    if not groups:
        return []
    weights, step = model["weights"], np.array(model["step"])
    share = sum(c.isdigit() for c in text) / len(text)
    out = []
    for group in groups:
        low, high = max(0, group[0][0] - REACH), group[-1][1] + REACH
        low = text.rfind("\n", low, group[0][0]) + 1 or low
        if (end := text.find("\n", group[-1][1], high)) >= 0:
            high = end
        spans, parts = chain(text, group, low, high)
        tokens = [text[a:b] for a, b in spans]
        score = np.zeros((len(tokens), 3))
        for i, found in enumerate(_featured(tokens, parts, share)):
            if found:
                score[i] = [sum(x) for x in zip(*(weights[f] for f in found if f in weights), strict=True)]
        score[~_allowed(len(tokens), parts)] = -1e9
        tags = viterbi(score, step)
        for i, tag in enumerate(tags):
            if tag == BEGIN:
                out.append([*spans[i], "crf"])
            elif tag == INSIDE:
                out[-1][1] = spans[i][1]
    return [tuple(x) for x in out]


def all_spans(text: str, model: dict) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans; and these with what the field's spans have beyond them, but for the label before an assignment."""
    base = base_spans(text)
    more, upto = [], list(itertools.accumulate((b for _, b, _ in base), max))
    for start, end, kind in field_spans(text, model):
        for a, b, what in itertools.islice(base, bisect_right(upto, start), None):  # those before end before it starts
            if a >= end:
                break
            if b > start:
                if a > start and what != "assign":
                    more.append((start, a, kind))
                start = max(start, b)
        if start < end:
            more.append((start, end, kind))
    return base, sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """docs (doc_id, text, ...) -> a row for each row: doc_id, n_assign, n_access, n_hex, base, spans, redacted.

    base and spans list kind:start:end (code points, end exclusive) by start, then kind; spans has the field's as well.
    redacted is the text with every span replaced by [SECRET]; null for a null text, which has no spans otherwise. Further
    columns are ignored, an empty table gives an empty one."""
    model = model or trained()

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text or "", model)
                n = Counter(x[2] for x in base)
                out.append((n["assign"], n["access"], n["hex"], listed(base), listed(spans), None if text is None else redacted(text, spans) if spans else text))
            if out:
                kinds = (*[pa.int64()] * 3, *[pa.string()] * 3)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans", "redacted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, redacted string")


def clean(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """docs (text, ...) with every secret span replaced by [SECRET]; other columns and null texts stay as they are."""
    model = model or trained()

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index("text")
            new = [x and redacted(x, all_spans(x, model)[1]) for x in batch.column(i).to_pylist()]
            yield batch.set_column(i, batch.schema.field(i), pa.array(new, batch.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)
