import re
import time
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterstream.llm import pseudonyms as P

KEY = b"0123456789abcdef"
DO, UNDO = P.Permutation(KEY), P.Permutation(KEY, inverse=True)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 256, 1000])
def test_permutation_is_one_to_one(size):
    image = [DO.walk("t", x, size) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert [UNDO.walk("t", y, size) for y in image] == list(range(size))
    if size > 90:
        assert image != [P.Permutation(b"another key of16").walk("t", x, size) for x in range(size)]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


VALUES = {
    "card": ["4111111111111111", "4111-1111-1111-1111", "5500 0000 0000 0004", "3400 000000 00009"],
    "phone": ["+1 (017) 555-7713", "+44 20 7946 0958", "(212) 555-0199", "212-555-0199"],
    "ipv4": ["1.2.3.4", "97.51.17.173", "255.255.255.255"],
    "day": ["2001-02-03", "12/31/1999", "31/12/1999", "1.2.2003", "29.02.2000"],
    "ssn": ["078-05-1120", "899-99-9999"],
    "email": ["nt.26@mail6.example.com", "queê.55@mail4.example.com", "A_b+c9@x.org"],
}
INVALID = ["4111111111111112", "256.1.1.1", "01.2.3.4", "2001-02-30", "45/45/2000", "000-12-1234", "666-12-1234", "123-00-1234",
           "1.2.3.4.5", "version 2.0", "1234567", "12345678901234567890123", "0000000000000000"]
VALID = {"card": luhn, "ipv4": lambda s: all(0 <= int(x) <= 255 and x == str(int(x)) for x in s.split(".")),
         "day": lambda s: any(_day(s, o) for o in ((0, 1, 2), (2, 0, 1), (2, 1, 0)))}


def _day(s, order):
    try:
        p = [int(x) for x in re.split(r"\D", s)]
        return 1900 <= date(*(p[i] for i in order)).year <= 2099
    except ValueError:
        return False


@pytest.mark.parametrize("kind", VALUES)
def test_format_is_kept_and_values_return(kind):
    for v in VALUES[kind]:
        text = f"Word {v} word, {v}!!"
        new, found = P.replaced(text, DO)
        assert [f["kind"] for f in found] == [kind] * 2, (v, found)
        a, b = (new[f["start"]:f["end"]] for f in found)
        assert a == b != v and len(new) == len(text)
        shape = lambda x: re.sub("[A-Z]", "A", re.sub(r"\d", "9", re.sub("[a-z]", "a", x)))
        assert shape(a) == shape(v)
        assert VALID.get(kind, bool)(a)
        assert P.replaced(new, UNDO)[0] == text


def test_secrets_and_invalid_values():
    t = 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" and TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!!'
    new, found = P.replaced(t, DO)
    assert [f["kind"] for f in found] == ["secret"] * 2 and P.replaced(new, UNDO)[0] == t
    assert re.sub("[0-9a-f]{40}", "", re.sub("[0-9A-F]{40}", "", new)) == re.sub("[0-9a-f]{40}", "", re.sub("[0-9A-F]{40}", "", t))
    for v in INVALID:
        assert P.replaced(f"a {v} b", DO) == (None, []), v
    a, b = "7536784127813057", "4111111111111111"
    assert [f["kind"] for f in P.replaced(f"{a} {b}", DO)[1]] == ["card"] * (luhn(a) + luhn(b))


def test_neighbours_do_not_hide_or_change_a_value():
    phone, ip = "+1 (826) 555-4081", "190.137.223.204"
    alone = P.replaced(phone, DO)[0]
    for text in (f"{phone} {ip}", f"{ip} {phone}", f"{phone} 25 or {phone}", f"a.b@c.org {phone} {phone}", f"\0{phone}\0"):
        new, found = P.replaced(text, DO)
        phones = [new[f["start"]:f["end"]] for f in found if f["kind"] == "phone"]
        assert phones == [alone] * text.count(phone) and P.replaced(new, UNDO)[0] == text
        assert [f["kind"] for f in found].count("ipv4") == text.count(ip)


def test_many_values_stay_distinct():
    cards = [f"41111111{i:07}" for i in range(500)]
    cards = [c + str(P.check_digit([int(x) for x in c])) for c in cards]
    assert len({P.card(c, DO) for c in cards}) == 500
    days = [f"{d}/{m}/2000" for d in range(1, 10) for m in range(1, 10)]
    new = [P.day(d, DO) for d in days]
    assert len(set(new)) == 81 and all(len(x) == 8 for x in new) and [P.day(x, UNDO) for x in new] == days


def test_documents(spark):
    rows = [(1, "call +1 (017) 555-7713", 1), (2, "again: +1 (017) 555-7713.", 2), (2, "again: +1 (017) 555-7713.", 2), (3, None, 3), (4, "", 4),
            (None, "x " * 60_000 + "97.51.17.173", 5), (5, "nothing 12 here", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, FOUND int")
    out = P.pseudonymise(docs, KEY)
    assert out.columns == ["doc_id", "text", "found"]
    got = out.collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert by[1].text[5:] == by[2].text[7:-1] != "+1 (017) 555-7713" and by[3].text is None and by[4].text == ""
    assert by[5].text == "nothing 12 here" and by[5].found == [] and by[None].found[0].kind == "ipv4"
    kept = P.pseudonymise(docs, KEY, found=None)
    assert kept.columns == docs.columns and kept.schema["FOUND"].dataType.simpleString() == "int"
    back = P.pseudonymise(kept, KEY, inverse=True, found=None).collect()
    assert sorted(map(str, back)) == sorted(map(str, docs.collect()))
    assert P.pseudonymise(docs.limit(0), KEY).count() == 0


@pytest.mark.parametrize("kind,value", [
    ("day", "2024/05/01"), ("day", "2024.05.01"), ("day", "2024/5/1"), ("day", "01-05-2024"), ("day", "5-1-2024"), ("day", "12-31-1999"),
    ("phone", "(555)123-4567"), ("phone", "(555)123.4567")])
def test_other_usual_forms(kind, value):
    text = f"Word {value} word, {value}."
    new, found = P.replaced(text, DO)
    assert [f["kind"] for f in found] == [kind] * 2
    a, b = (new[f["start"]:f["end"]] for f in found)
    assert a == b != value and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", value)
    assert VALID.get(kind, bool)(a) and P.replaced(new, UNDO)[0] == text


def test_forms_that_are_no_days():
    for v in ["2024/13/01", "2024.02.30", "2024-05/01", "31-31-2024", "1-2-3-2024", "2024/05/01/7"]:
        assert P.replaced(f"a {v} b", DO) == (None, []), v


@pytest.mark.parametrize("separator", "-/.")
def test_days_of_both_orders_return(separator):
    days = [separator.join((f"{a:02}", f"{b:02}", str(y))) for y in range(1995, 2000) for a in range(1, 29) for b in (5, 12, 20) if min(a, b) < 13]
    new = [P.day(d, DO) for d in days]
    assert len(set(new)) == len(days) and [P.day(x, UNDO) for x in new] == days


OLD_ADDRESS = re.compile(r"[\w.%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")


@settings(max_examples=500, deadline=None)
@given(st.text("ab.@-_% 1c", max_size=30))
def test_addresses_are_those_of_the_pattern(text):
    assert list(P.addresses(text)) == [m.span() for m in OLD_ADDRESS.finditer(text)]


@pytest.mark.parametrize("text", [
    "x" * 10**6 + " @", "x" * 10**6 + "@", "@" + "x" * 10**6, "x@" + "a." * 500_000 + "1", "x@" * 500_000, "@" * 10**6, "1" * 10**6 + "@",
    "1." * 500_000, "1-" * 500_000, "token" + " " * 10**6 + "@", "token= " * 150_000 + "@", "token=" + "a" * 10**6 + "@", "+1" * 500_000,
    "(1" * 500_000, "1234 " * 200_000, "2020-1-" * 150_000], ids=lambda t: t[:6])
def test_long_runs_take_linear_time(text):
    p = P.Permutation(b"0123456789abcdef")
    began = time.process_time()
    P.replaced(text[:len(text) // 8], p)
    eighth = time.process_time() - began
    began = time.process_time()
    P.replaced(text, p)
    assert time.process_time() - began < 5 + 20 * eighth  # quadratic would be minutes


def test_very_long_addresses_turn_back():
    there, back = (P.Permutation(b"0123456789abcdef", inverse=i) for i in (False, True))
    for value in ("ab" * 5000 + "@x.com", "q" * 64 + "@x.com", "q" * 65 + "@" + "d." * 60_000 + "com"):
        new, found = P.replaced(f"to {value} now", there)
        assert len(new) == len(value) + 7 and new != f"to {value} now" and len(found) == 1
        assert P.replaced(new, back)[0] == f"to {value} now"


class PlainPermutation:
    """A second version of the network: halves as lists of bits, rounds written out."""

    def __init__(self, key):
        self.key = key

    def round(self, tag, i, half, x):
        from hashlib import blake2b
        size, out, n = (half + 7) // 8, b"", 0
        while len(out) < size:
            data = bytes([i]) + len(tag).to_bytes(2, "big") + tag + x.to_bytes(size, "big") + len(out).to_bytes(2, "big")
            out += blake2b(data, key=self.key, digest_size=min(64, max(16, size))).digest()
            n += 1
        return int.from_bytes(out[:size], "big") % (1 << half)

    def walk(self, name, x, size):
        bits = 0
        while 1 << bits < size:
            bits += 1
        half, tag = (bits + 1) // 2, f"{name}/{size}".encode()
        while True:
            a, b = divmod(x, 1 << half)
            for i in range(10):
                a, b = b, a ^ self.round(tag, i, half, b)
            x = a * (1 << half) + b
            if x < size:
                return x


@pytest.mark.parametrize("size", [2, 3, 10, 999, 10**4, 10**15, 898 * 99 * 9999, 26**40])
def test_the_network_equals_a_second_version(size):
    second = PlainPermutation(KEY)
    for x in {0, 1, size // 3, size // 2, size - 1}:
        assert DO.walk("card", x, size) == second.walk("card", x, size)


def luhn_of(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = d * (1 + n % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def plain_kind(token):
    """What a word by itself is, without patterns."""
    digits = [int(c) for c in token if c.isdigit()]
    parts = token.split(".")
    if token.count("@") == 1:
        return "email"
    if len(parts) == 4 and all(p.isdigit() and len(p) < 4 for p in parts):
        return "ipv4" if all(int(p) < 256 and str(int(p)) == p for p in parts) else None
    for sep in "-/.":
        p = token.split(sep)
        if len(p) == 3 and all(x.isdigit() for x in p) and [len(x) for x in p] in ([4, 2, 2], [2, 2, 4]):
            orders = [(0, 1, 2)] if len(p[0]) == 4 else [(2, 0, 1), (2, 1, 0)]
            for order in orders:
                try:
                    if 1900 <= date(*(int(p[i]) for i in order)).year < 2100:
                        return "day"
                except ValueError:
                    pass
        if sep == "-" and [len(x) for x in p] == [3, 2, 4] and all(x.isdigit() for x in p):
            a, g, s = map(int, p)
            return "ssn" if 0 < a < 900 and a != 666 and g and s else None
    if token.isdigit() and 13 <= len(token) <= 19:
        return "card" if luhn_of(digits) and len(set(digits)) > 1 else None
    return None


def test_found_are_the_words_a_second_version_finds():
    import random
    r = random.Random(21)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def word():
        k = r.randrange(9)
        if k == 0:
            return f"{r.choice(['ann', 'b.c', 'x_1'])}@mail{r.randrange(9)}.example.com"
        if k == 1:
            return ".".join(str(r.choice([0, 7, 99, 255, 256, 300])) for _ in range(4))
        if k in (2, 3):
            sep = r.choice("-/.")
            y, m, d = str(r.choice([1899, 1900, 2024, 2100])), f"{r.randrange(0, 14):02}", f"{r.randrange(0, 33):02}"
            return sep.join(r.choice([(y, m, d), (m, d, y), (d, m, y)]))
        if k == 4:
            return f"{number(3)}-{number(2)}-{number(4)}"
        if k in (5, 6):
            x = number(r.choice([12, 13, 15, 16, 19, 20]))
            return x[:-1] + str(P.check_digit([int(c) for c in x[:-1]])) if r.random() < 0.6 else x
        return r.choice(["word", "a1", "12", "3.5", "x-y"])

    for _ in range(1500):
        words = [word() for _ in range(r.randint(1, 8))]
        text = " and ".join(words)
        want = [(plain_kind(w), w) for w in words if plain_kind(w)]
        new, found = P.replaced(text, DO)
        assert [(f["kind"], text[f["start"]:f["end"]]) for f in found] == want, text
        if found:
            assert [plain_kind(new[f["start"]:f["end"]]) for f in found] == [k for k, _ in want] and P.replaced(new, UNDO)[0] == text
