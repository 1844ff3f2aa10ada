"""The whole of finding, validating and replacing against a second implementation in Python."""

import hashlib
import random
import re
from datetime import date, timedelta

from larkspan.llm import pii

KEY = "brute key"


def feistel(value, a, b, tweak):
    left, right = divmod(value, b)
    for i in range(pii.ROUNDS):
        own, size = (right, a) if i % 2 == 0 else (left, b)
        step = int(hashlib.sha256(f"{KEY}|{tweak}|{i}|{own}|{KEY}".encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            left = (left + step) % size
        else:
            right = (right + step) % size
    return left * b + right


def permuted(digits, tweak):
    low = len(digits) // 2
    return str(feistel(int(digits), 10 ** (len(digits) - low), 10**low, f"{tweak}|{len(digits)}")).zfill(len(digits))


def luhn(digits, doubled):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 == doubled else int(c) for k, c in enumerate(reversed(digits)))


def filled(shape, digits):
    rest = iter(digits)
    return "".join(next(rest) if c in "0123456789" else c for c in shape)


def day(value):
    for pattern, order in ((r"(\d{4})-(\d\d)-(\d\d)", "ymd"), (r"(\d{4})/(\d\d)/(\d\d)", "ymd"), (r"(\d\d)\.(\d\d)\.(\d{4})", "dmy"), (r"(\d\d)/(\d\d)/(\d{4})", "dmy"), (r"(\d\d)/(\d\d)/(\d{4})", "mdy")):
        if m := re.fullmatch(pattern, value):
            try:
                return date(*(int(m[order.index(c) + 1]) for c in "ymd")), order
            except ValueError:
                continue
    return None


def kind(v):
    digits = re.sub("[^0-9]", "", v)
    if "@" in v:
        return "email"
    if re.fullmatch(pii._DATE, v):
        return "date" if day(v) else None
    if re.fullmatch(pii._IP, v):
        return "ip" if all(int(x) <= 255 for x in v.split(".")) else None
    if re.fullmatch(pii._SSN, v):
        return "ssn" if re.match(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)", v) else None
    if re.fullmatch(pii._CARD, v) and luhn(digits, 1) % 10 == 0 and v[0] != "0":
        return "card"
    return "phone" if re.fullmatch(pii._PHONE, v) and 7 <= len(digits) <= 15 else None


def letters(text):
    low, number = len(text) // 2, 0
    for c in text:
        number = number * 26 + ord(c) - 97
    new, out = feistel(number, 26 ** (len(text) - low), 26**low, f"letters|{len(text)}"), ""
    for _ in text:
        new, c = divmod(new, 26)
        out = chr(97 + c) + out
    return out


def replaced(v, k):
    if k == "email":
        local, domain = v.lower().split("@")[0], v.rpartition("@")[2]
        runs = re.findall("[a-z]{1,12}|[0-9]{1,12}|[^a-z0-9]", local)
        return "".join(letters(r) if r[0].isalpha() else permuted(r, "mail") if r[0].isdigit() else r for r in runs) + "@" + domain
    if k == "date":
        own, order = day(v)
        new = date(1900, 1, 1) + timedelta(feistel((own - date(1900, 1, 1)).days, 229, 319, "date"))
        if order == "ymd":
            return f"{new:%Y}{v[4]}{new:%m}{v[4]}{new:%d}"
        return f"{new:%d}{v[2]}{new:%m}{v[2]}{new:%Y}" if order == "dmy" else f"{new:%m/%d/%Y}"
    if k == "ip":
        new = feistel(int.from_bytes(map(int, v.split("."))), 1 << 16, 1 << 16, "ip")
        return ".".join(map(str, new.to_bytes(4)))
    if k == "ssn":
        area, group, serial = map(int, v.split("-"))
        left, serial = divmod(feistel(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, "ssn"), 9999)
        area = left // 99 + 1
        return f"{area + (area >= 666):03}-{left % 99 + 1:02}-{serial + 1:04}"
    digits = re.sub("[^0-9]", "", v)
    if k == "card":
        head = digits[: max(0, len(digits) - 18)]
        new = head + permuted(digits[len(head) : -1], "card")
        return filled(v, new + str(-luhn(new, 0) % 10))
    if k == "phone":
        code = m[0] if (m := re.match(r"\+\d{1,3}(?=[ .(-])", v)) else ""
        rest = v[len(code) :]
        return code + filled(rest, permuted(re.sub("[^0-9]", "", rest), f"phone|{code}"))
    return v


def brute(text):
    kinds = []

    def one(m):
        k = kind(m[0])
        kinds.append(k)
        return replaced(m[0], k)

    out = re.sub(pii.PATTERN, one, text)
    return [k for k in kinds if k], out


def value(rng):
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    card = d(rng.choice([12, 14, 15, 17, 18]))
    card = "4" + card[1:] + str(-luhn("4" + card[1:], 0) % 10) if rng.random() < 0.8 else card
    spaced = " ".join(card[i : i + 4] for i in range(0, 16, 4)) if len(card) == 16 else card
    own = date(1900, 1, 1) + timedelta(rng.randrange(73000))
    choices = [card, spaced, f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"+{rng.randrange(1, 400)} {d(3)} {d(3)} {d(3)}", f"({d(3)}) {d(3)}-{d(4)}", ".".join(str(rng.randrange(300)) for _ in range(4)), f"{own:%Y-%m-%d}", f"{own:%Y/%m/%d}", f"{own:%d.%m.%Y}", f"{own:%m/%d/%Y}", f"{own:%d/%m/%Y}", f"{d(2)}/{d(2)}/20{d(2)}"]
    return rng.choice([*choices, f"{rng.choice(['Ann.B', 'x_9', 'longlonglongname', 'a1b22'])}{d(rng.randrange(3))}@mail{d(1)}.example.org", d(rng.randrange(1, 22)), "word", "end."])


def test_against_a_second_implementation(docs):
    rng = random.Random(12)
    rows = [(i, "".join(value(rng) + rng.choice([" ", ", ", "\n", ". ", "; x ", "-", ""]) for _ in range(rng.randrange(0, 12)))) for i in range(250)]
    got = {r.doc_id: (r.kinds, r.n_found, r.text) for r in pii.pseudonymised(docs(rows), KEY).collect()}
    want = {i: (k := brute(t))[:1] + (len(k[0]), k[1]) for i, t in rows}
    assert sum(n for _, n, _ in want.values()) > 400
    assert {i: got[i] for i in want} == want
