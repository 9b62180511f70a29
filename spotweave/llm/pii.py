"""Personal data: fixed patterns, plus a linear-chain conditional random field over word shapes.

The field reads the shapes of a word and its neighbours: digit groups and separators, first characters, check
sums, what else the word may be (a date, an amount, a book number), and cue words.  It marks spans of the four
kinds that the patterns miss, such as telephone numbers without a plus sign, spelled-out addresses and
card numbers in odd groups.  It is trained at the start from LABELLED, a small table of rows written for it,
varied in digits and words, with exact gradients by forward-backward.  A shape that was never seen is judged
by the features that were.  Words that are not near one with a digit, an at-sign or the word dot are given
the label O, which cuts a text into short chains; Viterbi decodes all chains of a batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.batches import steps

KINDS = ("email", "ip", "card", "phone")
# The patterns; each begins where a run of its characters begins, so no text takes quadratic time.
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = bytes(sorted(set(range(256)) - set(b"0123456789")))


def luhn(digits: bytes) -> bool:
    """The check sum of card numbers: every second digit from the right doubled, digit sums added."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def pattern_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the base patterns, each kind leftmost and without overlaps."""
    found = []
    free, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, 0, m.end()))
            free = m.end()
        at = text.find(b"@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(len(part.lstrip(b"0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(b".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := m[0].translate(None, NOT_DIGIT)) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(m[0].translate(None, NOT_DIGIT)) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---- the field: labels O and B-/I- of each kind -----------------------------------------------
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
N_LABELS = len(LABELS)
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
REACH = 3  # words on either side of a word with a digit, an at-sign or the like that may be part of a span
AROUND = (-2, -1, 0, 1, 2, 3)  # words whose features speak for a word's label, by their distance
CACHED_WORDS = 16_384
ROWS = 1_024  # rows that are worked on at once
# Words that speak for or against personal data beside them.
CUES = frozenset(
    b"at dot phone tel call fax mobile cell ring dial whatsapp sms text telephone telefon telefono hotline toll free numero rufnummer card visa mastercard credit pay paid account ip host server gateway ping router "
    b"address mail email e-mail contact write ask com org net de edu fr es info io co uk version release chapter page pages pp isbn room order invoice no nr number total population euros euro eur usd dollars percent "
    b"km m kg year years since from to between until in of and uhr id ref article section build batch serial score pi about over lat lon born died see sum zip plus minus parcel row rows ticket case law line bus".split()
)
PIECES = re.compile(rb"[0-9]+|[A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]")
DATE = re.compile(rb"(?:1[0-9]|20)[0-9]{2}[-./](?:0?[1-9]|1[0-2])[-./][0-3]?[0-9]|[0-3]?[0-9][-./][0-3]?[0-9][-./](?:(?:1[0-9]|20)[0-9]{2}|[0-9]{2})")
YEARS = re.compile(rb"\(?(?:1[0-9]|20)[0-9]{2}(?:[-/](?:(?:1[0-9]|20)?[0-9]{2}))?\)?")
CLOCK = re.compile(rb"[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?")
AMOUNT = re.compile(rb"[0-9]{1,3}(?:[,.'][0-9]{3})+(?:[.,][0-9]{1,2})?|[0-9]+[.,][0-9]+")
SIX = re.compile(rb"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{3,39}\Z)(?:[0-9A-Fa-f]{1,4}:)*:?(?::[0-9A-Fa-f]{1,4})*")
PAIRS = re.compile(rb"[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}")
PARTED = re.compile(rb"[0-9]+(?:(\.|\[\.\]|\(\.\)|\{\.\})[0-9]+)(?:\1[0-9]+){2}")
SPELLED = re.compile(rb"[^\s@]+[\[({]at[\])}][^\s@]+", re.I)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer in which texts are parted by a blank."""
    solid = np.concatenate([[False], ~BLANK[data], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def word_features(word: bytes) -> list[str]:
    """Features of a word's shape: its digit groups and separators, its beginning, what it may be, or whether it is a cue."""
    core = word.strip(b"\"'").rstrip(b".,;:!?") or word
    out = ["any", "stop" if word[-1:] in b".;!?" else "comma" if word[-1:] == b"," else "open"]
    digits = core.translate(None, NOT_DIGIT)
    bare = core.strip(b"()[]{}<>:.#\"'").lower()
    if not digits and b"@" not in core:
        out.append("cue " + bare.decode() if bare in CUES else "word" if bare.isalpha() or max(bare, default=0) > 127 else "mark")
        if SPELLED.fullmatch(core):
            out.append("spelled")
        if core[:1] in b"([" and bare in (b"at", b"dot"):
            out.append("bracketed")
        return [*out, "capital"] if core[:1].isupper() else out
    parts = PIECES.findall(core)
    shape = "".join(f"d{min(len(p), 21)}" if p[0] in b"0123456789" else "a" if p.isalpha() or p[0] > 127 else p.decode("latin-1") for p in parts)
    groups = [p for p in parts if p[:1].isdigit()]
    marks = "".join(sorted({p.decode("latin-1") for p in parts if not p[:1].isdigit() and not (p.isalpha() or p[0] > 127)}))
    out += ["shape " + shape, f"digits {min(len(digits), 21)}", f"groups {min(len(groups), 6)}", "marks " + marks, "first " + (core[:1].decode("latin-1") if not core[:1].isalpha() else "a")]
    if groups:
        out.append(f"last {min(len(groups[-1]), 9)}")
        out.append("zeros" if groups[0].startswith(b"00") else "zero" if groups[0].startswith(b"0") else "none")
        if all(p[:1].isdigit() for p in parts):
            out.append("bare")
    if any(p.isalpha() for p in parts):
        out += ["letters", f"letters beside {min(len(digits) // 4, 3)}"]
    inside = core.strip(b"()[]")
    for name, pattern in (("date", DATE), ("years", YEARS), ("clock", CLOCK), ("amount", AMOUNT), ("spelled", SPELLED)):
        if pattern.fullmatch(inside):
            out.append(name)
    if PAIRS.fullmatch(inside):
        out.append("pairs")
    if inside.count(b":") >= 2 and (b"::" in inside or inside.count(b":") == 7) and SIX.fullmatch(inside):
        out.append("six")
    if core[:1] in b"$#%" or core[-1:] in b"%$" or core[:2] in (b"\xc2\xa3", b"\xe2\x82") or core[-2:] in (b"\xc2\xb0",):
        out.append("unit")
    if len(digits) == 13 and digits[:3] in (b"978", b"979") or len(digits) == 10 and len(groups) in (1, 4) and not sum(k * (d - 48) for k, d in zip(range(10, 0, -1), digits)) % 11:
        out.append("book")
    if 13 <= len(digits) <= 19:
        out.append("luhn" if luhn(digits) else "no luhn")
    if PARTED.fullmatch(core) and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        out.append("octets")
    if b"@" in core:
        out.append("address" if re.fullmatch(rb"[^@\s]+@[^@\s]+", inside) else "handle" if core[:1] == b"@" else "sign")
    return out


# The labelled table: [kind|...] marks what is personal.  Rows of one kind of writing stand together; those without
# marks are what is easily mistaken for it.
LABELLED = """
call [phone|0171 5550123] after six
Tel. [phone|030/901820] (office)
toll free [phone|1 800 555 0199] any time
telephone [phone|01 42 68 53 00] or write
please ring [phone|555-1234] now
my phone is [phone|(555) 123-4567] at home
[phone|555-123-4567] is the number of the shop
fax [phone|555.123.4567].
from abroad dial [phone|00 44 20 7946 0958]
our London office, [phone|020 7946 0958], is open
mobile: [phone|07700 900123]
tel [phone|5550123], evenings
Rufnummer [phone|0800-123456] kostenlos
[phone|(030) 901820] Zentrale
[phone|0049 30 901820] Berlin
whatsapp [phone|612 345 678] hoy
reception [phone|91 123 45 67] and bar
Handy [phone|0151-23456789]
reach us on [phone|800-555-0199]
text [phone|06 12 34 56 78] to win
Buero [phone|0211 / 55 66 77]
the doctor ([phone|555-0188]) is in
hotline [phone|1-800-555-0142] day and night
call [phone|5550187] or [phone|5550188]
Ring [phone|01632 960123], ask for Mary
phone [phone|+44 1632 960123]
tel.: [phone|089-1234567]
office [phone|(415) 555-0123], home [phone|(415) 555-0199]
call [phone|07700 900456] or [phone|01632 960001] today
tel [phone|0 825 12 34 56] service
appelez le [phone|0 805 200 300]
telephone [phone|415-555-0123] / [phone|415-555-0177]
number [phone|(0221) 98765-0] is new
or [phone|555 0134] at night
cell [phone|212 555 0187]
call [phone|+1 (415) 555-0101] soon
of [phone|+1 (843) 555-0102] [ip|10.1.2.3] and
paid with [card|4111 1111 1111 1111] today
card [card|4111-1111-1111-1111] was stolen
the visa number [card|5500.0000.0000.0004]
[card|4012888888881881] expires soon
use [card|3782 822463 10005] instead
credit card [card|9807915762804490]
and then [card|2390409500648960] was
was [card|7536784127813050] [card|4845168114407329] seen
mastercard [card|5105 1051 0510 5100], please
[card|6011000990139424]. Thanks
charge [card|3714-496353-98431]
of the [card|1219538112535716] in
ping [ip|10[.]0[.]0[.]7] first
from host [ip|192[.]168[.]12[.]200]
server [ip|2001:db8::1] is down
the gateway fe80 is [ip|fe80::1ff:fe23:4567:890a].
address [ip|2001:0db8:85a3:0000:0000:8a2e:0370:7334] answered
route to [ip|2a02:26f0:fe::5]
the [ip|172.16.254.1] box
of [ip|97.51.17.173] and
blocked [ip|203(.)0(.)113(.)9]
write to [email|ann at example dot com] soon
mail [email|jane (at) example (dot) org]
[email|bob[at]site[dot]net] is mine
ask [email|info AT firm DOT de] about it
contact [email|mary.smith [at] mail [dot] com], please
send it to [email|sales(at)shop.example.org]
email [email|peter @ company.com] today
or [email|j.doe at uni dot edu].
with [email|und.34@mail7.example.com] and
mail me at [email|tom at web dot de]
the address is [email|help(at)desk(dot)info]
we saw 12 birds in 1999 at 10:30
the value of pi is 3.14159265 or so
ISBN 978-3-16-148410-0 is the second edition
isbn 9783161484100 and 0-306-40615-2
his number was 123-45-6789 until then
on 2024-05-17 and on 17.05.2024 again
born 05/17/1984, died 12.3.2001
from 1999-2003 and 1914-1918
see pp. 123-130 and page 45
it cost $1,234.56 in all
12 500 euros for 1 234 567 people
over 10 000 000 copies, 250 000 of them here
version v1.2.3 and release 2.10.4
order 4711-0815 and invoice 2023-00123
ticket #123456 of batch A-12345
room 555 on floor 3
they won 3-1 and lost 2-4
at 52.5200, 13.4050 on the map
lat 48.8566 lon 2.3522
about 45% of 20,000
token 233A8ECF7C5B09FE5949719B6B82BC439E9329B
key = "a45e15e09fd311c3cf3163b66d5a9875b883d8ce"
id 550e8400-e29b-41d4-a716-446655440000
the serial 12345678 and 87654321
10115 Berlin or 90210-1234
numbers 24 12 36 48 and 7 14 21 28
section 12.3.4 and chapter 7
build 20230117 of 11:45:10
the MAC 00:1B:44:11:3A:B7 is set
follow @handle and @other99
meet me at noon, dot the letters
look at the dot on the map
at one point in 1987 the dot com boom
a dot at the end
Licensed under CC BY-NC 4.0.
General Public License, version 3.
the population was 3 645 000 in 2020
score 98765 by player42
in 1 800 cases of 2 500
temperatures of 21 22 19 18 degrees
A4 paper, B2 level, R2D2
article 5(2) and paragraph 17(b)
between 100-200 and 300-400 rows
he ran 42.195 km in 2:05:42
parcel 00340434161094042557 arrived
call it 42 or call it 1984
law 2016/679 and case 6-64
about 5000000 years, 4600000000 in all
phone 7 and phone 12 are old models
the bus 555 and line 1234
no. 5551 of 9999
cards 1 2 3 4 and 5 6 7 8
EAN 4006381333931 on the box
ref 1234567890123 and 98765432101234567890
from 12:30 to 14:45 on 3/4
two plus 2 is 4, 16 minus 8
zip 75008 Paris, 28013 Madrid
row 17 24 33 41 52 60
tracking RB123456785US and JD0002212345678901
plate B-XY 1234 and M-AB 77
part 77-1020-3 of model 4400-12
order 70-22931 shipped, invoice 2020-118822 open
job 19991231-07 finished
the ISBN 3-16-148410-X or 0-8044-2957-X
ISBN 0-262-03384-4 and 0-201-63361-2
isbn 0-13-110362-8 is sold, 0-262-51087-1 too
see 0-201-89683-4 (first volume)
population: 4 120 330 in 1990
with 1 204 557 inhabitants and 2 300 400 visitors
died 09/11/1973, born 04.02.1921
tracking 4R12AB99100234567 and 7G0000918273645A
levels of 6.5-7.2 and 0.35-0.45
signed on 03/04/2011 and 28/02/1997
due 1/12/2023, paid 11-11-2022
on 31.12.1999 and by 2001/09/30
ether 08:00:27:4E:66:A1 and A0:B1:C2:D3:E4:F5
article 20-17 of law 99-1172
lot 30114-2 of 2018
the score of 6-4, 7-6 and 30-15
between 2019 and 2021, see 7.1
sum 1,000,000.00 or 1.000.000,00
the score was 112-104 after 48 minutes
"""


def labelled_examples(seed: int = 11, copies: int = 10) -> list[tuple[bytes, list[int]]]:
    """Texts and their words' labels: each row of the table as it is, and with other digits and other words around.

    In a copy each digit behind a group's first is drawn anew, but for dates and book numbers, and plain words are exchanged; cues and shapes stay.
    """
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word() -> str:
        w = "".join(letters[i] for i in rng.integers(0, 26, rng.integers(1, 9)))
        return w.capitalize() if rng.random() < 0.2 else w + ("", "", "", "", ",", ".")[rng.integers(6)]

    made = []
    for row in LABELLED.strip().split("\n"):
        parts = [p for p in re.split(r"\[(email|ip|card|phone)\|((?:[^\[\]]|\[[^\]]*\])*)\]", row)]
        words: list[tuple[str, int]] = []
        glue = False  # a mark that touches a span belongs to its word
        for i in range(0, len(parts), 3):
            plain = parts[i].split()
            if glue and plain and not parts[i][0].isspace():
                words[-1] = (words[-1][0] + plain.pop(0), words[-1][1])
            before = ""
            if i + 2 < len(parts) and plain and not parts[i][-1].isspace():
                before = plain.pop()
            words += [(w, 0) for w in plain]
            if i + 2 < len(parts):
                kind = 1 + 2 * KINDS.index(parts[i + 1])
                inside = parts[i + 2].split()
                words += [((before if j == 0 else "") + w, kind + (j > 0)) for j, w in enumerate(inside)]
                glue = True
        marked = any(label for _, label in words)
        for copy in range(copies):
            text, labels = [], []
            for w, label in words:
                if copy and (marked or rng.random() < 0.5):
                    w = w if "date" in word_features(w.encode()) or "book" in word_features(w.encode()) else re.sub(r"(?<=[0-9])[0-9]", lambda m: str(rng.integers(10)), w)
                if copy and w.strip(".,:;!?()").isalpha() and w.strip(".,:;!?()").lower().encode() not in CUES and rng.random() < 0.7:
                    w = word() if not label else word().strip(",.")
                text.append(w)
                labels.append(label)
            lead, tail = ([word() for _ in range(rng.integers(0, 4))] if copy else [] for _ in range(2))
            made.append((" ".join([*lead, *text, *tail]).encode(), [0] * len(lead) + labels + [0] * len(tail)))
    return made


def _allowed() -> np.ndarray:
    """Transitions: I follows B or I of its kind alone."""
    ok = np.zeros((N_LABELS, N_LABELS))
    for i in range(N_LABELS):
        for j in range(N_LABELS):
            if LABELS[j][0] == "I" and not (i > 0 and LABELS[i][2:] == LABELS[j][2:]):
                ok[i, j] = -1e4
    return ok


@cache
def train(rounds: int = 80, rate: float = 0.5, decay: float = 3e-4) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Numbers of the features, their weights for each place around a word, and transitions; by Adagrad on exact gradients.

    The table is small, so this takes seconds; it is run once in the driver.
    """
    examples = labelled_examples()
    found = [[word_features(w) for w in text.split()] for text, _ in examples]
    names = {name: i for i, name in enumerate(sorted({f for row in found for w in row for f in w}))}
    n, longest = len(examples), max(len(labels) for _, labels in examples)
    left, right = -AROUND[0], AROUND[-1]
    onehots = np.zeros((n, left + longest + right, len(names)), np.float32)
    gold, size = np.zeros((n, longest), np.int64), np.array([len(labels) for _, labels in examples])
    for i, (row, (_, labels)) in enumerate(zip(found, examples)):
        gold[i, : len(labels)] = labels
        for t, of in enumerate(row):
            onehots[i, left + t, [names[f] for f in of]] = 1
    flat = onehots.reshape(-1, len(names))
    mask = np.arange(longest) < size[:, None]
    weights, moves = np.zeros((len(AROUND), len(names), N_LABELS)), np.zeros((N_LABELS, N_LABELS))
    sums, move_sums, fixed = np.full_like(weights, 1e-2), np.full_like(moves, 1e-2), _allowed()
    start = np.where([name[0] == "I" for name in LABELS], -1e4, 0.0)
    known = np.eye(N_LABELS)[gold] * mask[:, :, None]
    for _ in range(rounds):
        emit = np.zeros((n, longest, N_LABELS))
        for k, off in enumerate(AROUND):
            emit += (flat @ weights[k].astype(np.float32)).reshape(n, -1, N_LABELS)[:, left + off : left + off + longest]
        step = moves + fixed
        alpha, beta = np.zeros((longest, n, N_LABELS)), np.zeros((longest, n, N_LABELS))
        alpha[0] = emit[:, 0] + start
        for t in range(1, longest):
            x = alpha[t - 1][:, :, None] + step
            top = x.max(1)
            alpha[t] = np.where(mask[:, t, None], top + np.log(np.exp(x - top[:, None]).sum(1)) + emit[:, t], alpha[t - 1])
        total = np.logaddexp.reduce(alpha[-1], axis=1)
        for t in range(longest - 2, -1, -1):
            x = step + (emit[:, t + 1] + beta[t + 1])[:, None, :]
            top = x.max(2)
            beta[t] = np.where(mask[:, t + 1, None], top + np.log(np.exp(x - top[:, :, None]).sum(2)), beta[t + 1])
        p = np.exp(np.minimum(alpha + beta - total[:, None], 0)).transpose(1, 0, 2) * mask[:, :, None]
        error, move_grad = (known - p).astype(np.float32), np.zeros_like(moves)
        for t in range(1, longest):
            pair = np.exp(np.minimum(alpha[t - 1][:, :, None] + step + (emit[:, t] + beta[t])[:, None, :] - total[:, None, None], 0)) * mask[:, t, None, None]
            move_grad -= pair.sum(0)
            np.add.at(move_grad, (gold[mask[:, t], t - 1], gold[mask[:, t], t]), 1)
        grad = np.empty_like(weights)
        for k, off in enumerate(AROUND):
            padded = np.zeros((n, onehots.shape[1], N_LABELS), np.float32)
            padded[:, left + off : left + off + longest] = error
            grad[k] = flat.T @ padded.reshape(-1, N_LABELS)
        for w, g, s in ((weights, grad / n - decay * weights, sums), (moves, move_grad / n - decay * moves, move_sums)):
            s += g * g
            w += rate * g / np.sqrt(s)
    return names, weights, moves + fixed


class Tagger:
    """Trained weights; a feature that was never seen speaks for nothing.  Small enough to travel with the task."""

    def __init__(self) -> None:
        self.names, weights, self.moves = train()
        self.weights = np.ascontiguousarray(weights.transpose(1, 0, 2))  # by feature, place around, label
        self.cached: dict[bytes, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cached": {}}

    def scores(self, word: bytes) -> np.ndarray:
        """What a word says for the labels of the words around it."""
        out = self.cached.get(word)
        if out is None:
            if len(self.cached) > CACHED_WORDS:
                self.cached.clear()
            out = self.weights[[self.names[f] for f in word_features(word) if f in self.names]].sum(0)
            if len(word) <= 64:
                self.cached[word] = out
        return out

    def decode(self, emit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of chains laid end to end: one Viterbi step for all chains that are long enough."""
        out = np.zeros(len(emit), np.int8)
        order = np.argsort(-lengths, kind="stable")
        first = (np.cumsum(lengths) - lengths)[order]
        alive = lengths[order]
        back = np.zeros((len(emit), N_LABELS), np.int8)
        start = np.where([name[0] == "I" for name in LABELS], -1e4, 0.0)
        score = emit[first] + start
        for t in range(1, int(alive[0]) if len(alive) else 0):
            n = int(np.searchsorted(-alive, -t, side="left"))
            reach = score[:n, :, None] + self.moves
            back[first[:n] + t] = reach.argmax(1)
            score[:n] = reach.max(1) + emit[first[:n] + t]
        label = score.argmax(1).astype(np.int8)
        for t in range(int(alive[0]) - 1 if len(alive) else -1, -1, -1):
            n = int(np.searchsorted(-alive, -t, side="left"))
            out[first[:n] + t] = label[:n]
            if t:
                label[:n] = back[first[:n] + t, label[:n]]
        return out

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, start, kind, end) in bytes of the buffer, which parts texts by a blank."""
        starts, ends = word_bounds(data)
        if not len(starts):
            return []
        # words with a digit, an at-sign, or at or dot in brackets, and the word dot
        seen = ((data >= 48) & (data < 58)) | (data == 64)
        low = data | 32
        opened = np.isin(data[:-3], np.frombuffer(b"[({", np.uint8))
        seen[:-3] |= opened & (((low[1:-2] == 97) & (low[2:-1] == 116)) | ((low[1:-2] == 100) & (low[2:-1] == 111))) if len(data) > 3 else False
        seen = np.concatenate([[0], np.cumsum(seen)])
        hot = seen[ends] > seen[starts]
        three = np.flatnonzero(ends - starts == 3)
        at = starts[three]
        hot[three] |= (low[at] == 100) & (low[at + 1] == 111) & (low[at + 2] == 116)
        text_of = np.searchsorted(offsets, starts, side="right") - 1
        near = hot.copy()
        for k in range(1, REACH + 1):
            same = text_of[k:] == text_of[:-k]
            near[k:] |= hot[:-k] & same
            near[:-k] |= hot[k:] & same
        at = np.flatnonzero(near)
        if not len(at):
            return []
        wanted = np.zeros(len(starts), bool)
        for off in AROUND:
            wanted[np.clip(at + off, 0, len(starts) - 1)] = True
        need = np.flatnonzero(wanted)
        raw = data.tobytes()
        table = np.zeros((len(need) + 1, len(AROUND), N_LABELS))  # the last row is what lies beyond a text
        for i, (a, b) in enumerate(zip(starts[need].tolist(), ends[need].tolist())):
            table[i] = self.scores(raw[a:b])
        row = np.full(len(starts), len(need))
        row[need] = np.arange(len(need))
        emit = np.zeros((len(at), N_LABELS))
        for k, off in enumerate(AROUND):
            other = np.clip(at + off, 0, len(starts) - 1)
            inside = (at + off == other) & (text_of[other] == text_of[at])
            emit += table[np.where(inside, row[other], len(need)), k]
        edge = np.concatenate([[True], text_of[1:] != text_of[:-1]])
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | edge[at[1:]]]))
        lengths = np.diff(np.append(cut, len(at)))
        labels = self.decode(emit, lengths)
        out = []
        begin = np.zeros(len(at), bool)
        begin[cut] = True
        for i in np.flatnonzero(labels):
            kind, inside = (int(labels[i]) - 1) // 2, labels[i] % 2 == 0
            if inside and out and not begin[i] and out[-1][2] == kind and out[-1][4] == at[i] - 1:
                out[-1][3], out[-1][4] = int(ends[at[i]]), int(at[i])
            else:
                out.append([int(text_of[at[i]]), int(starts[at[i]]), kind, int(ends[at[i]]), int(at[i])])
        return [tuple(x[:4]) for x in out]


TRIM = b".,:;!?\"'"
BRACKETS = ((b"(", b")"), (b"[", b"]"), (b"{", b"}"))


def trimmed(text: bytes, start: int, end: int) -> tuple[int, int]:
    """Bounds without punctuation at the ends and without brackets around the whole or without a partner."""
    while start < end:
        part = text[start:end]
        if any(part[:1] == a and part.find(b) == len(part) - 1 for a, b in BRACKETS):
            start, end = start + 1, end - 1
        elif part[0] in TRIM or any(part[:1] == a and b not in part for a, b in BRACKETS):
            start += 1
        elif part[-1] in TRIM or any(part[-1:] == b and a not in part for a, b in BRACKETS):
            end -= 1
        else:
            break
    return start, end


def detect(column: pa.Array, tagger: Tagger) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Per text: the base spans and the added spans, each as (start, kind, end) in code points.

    An added span is trimmed of punctuation at its ends and is dropped where it overlaps a base span.
    """
    out = []
    for low, high, offsets, data in steps(column):
        n = high - low
        padded = np.full(len(data) + n, 32, np.uint8)
        padded[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
        shifted = offsets[:-1] + np.arange(n)
        added: dict[int, list] = {}
        for i, start, kind, end in tagger.spans(padded, np.append(shifted, len(padded) + 1)):
            added.setdefault(i, []).append((start - int(shifted[i]), kind, end - int(shifted[i])))
        raw = data.tobytes()
        for i in range(n):
            text = raw[offsets[i] : offsets[i + 1]]
            base = pattern_spans(text)
            more = []
            for start, kind, end in added.get(i, ()):
                start, end = trimmed(text, start, end)
                if start < end and all(end <= s or start >= e for s, _, e in base):
                    more.append((start, kind, end))
            if (base or more) and not text.isascii():
                points = np.concatenate([[0], np.cumsum((data[offsets[i] : offsets[i + 1]] & 0xC0) != 0x80)])
                base = [(int(points[s]), k, int(points[e])) for s, k, e in base]
                more = [(int(points[s]), k, int(points[e])) for s, k, e in more]
            out.append((base, more))
    return out


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, and ``base`` and ``added`` spans as arrays of (kind, start, end).

    Offsets are code points of the whole text, ends exclusive.  A null or empty text has no spans;
    repeated rows give equal results; other columns are not read.
    """
    tagger = Tagger()
    span = "array<struct<kind:string,start:int,end:int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(spans: list) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                found = detect(part.column(1), tagger)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([rows(b) for b, _ in found], kind), pa.array([rows(m) for _, m in found], kind)], ["doc_id", "base", "added"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id long, base {span}, added {span}")


def mask_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in square brackets; overlapping spans merge."""
    merged: list[list] = []
    for start, kind, end in sorted(spans):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    out, at = [], 0
    for start, kind, end in merged:
        out += [text[at:start], f"[{KINDS[kind]}]"]
        at = end
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with every span in the text masked; a map without a shuffle."""
    tagger, at = Tagger(), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                texts = part.column(at)
                hit = {i: b + m for i, (b, m) in enumerate(detect(texts, tagger)) if b or m}
                masked = pa.array([mask_text(x.as_py(), hit[i]) if i in hit else x.as_py() for i, x in enumerate(texts)], texts.type)
                yield part.set_column(at, part.schema.field(at), masked)

    return docs.mapInArrow(run, docs.schema)
