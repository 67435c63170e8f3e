"""Second implementations in plain Python."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barlake.llm import packing, pii, shards, urls


def keyed(key: str, kind: str, *parts) -> int:
    return int(hashlib.sha256("|".join([key, kind, *map(str, parts)]).encode()).hexdigest()[:14], 16)


def pair(a: int, b: int, m: int, n: int, key: str, kind: str) -> tuple[int, int]:
    for r in range(1, pii.ROUNDS + 1):
        if r % 2:
            a = (a + keyed(key, kind, r, b)) % m
        else:
            b = (b + keyed(key, kind, r, a)) % n
    return a, b


def moved(half: str, other: str, second: bool, r: int, key: str, kind: str, alphabet) -> str:
    out = ""
    for i, c in enumerate(half):
        letters = alphabet(c, i, second)
        out += letters[(letters.index(c) + keyed(key, kind, r, i, other)) % len(letters)] if letters else c
    return out


def text(value: str, key: str, kind: str, alphabet) -> str:
    a, b = value[: len(value) // 2], value[len(value) // 2 :]
    for r in range(1, pii.ROUNDS + 1):
        if r % 2:
            a = moved(a, b, False, r, key, kind, alphabet)
        else:
            b = moved(b, a, True, r, key, kind, alphabet)
    return a + b


def digits(c: str, i: int, second: bool) -> str:
    return pii.DIGITS if c.isdigit() else ""


def phone_digits(c: str, i: int, second: bool) -> str:
    return pii.DIGITS if second or i not in (0, 3) else "01" if c in "01" else pii.FIRST


def by_class(c: str, i: int, second: bool) -> str:
    return next((s for s in (pii.DIGITS, pii.LOWER, pii.UPPER) if c in s), "")


def luhn(number: str) -> int:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10


def mod97(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value)) % 97


def ssn(v: str, key: str) -> str:
    area, group, serial = map(int, v.split("-"))
    a, b = pair((area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, pii.SSN_A, pii.SSN_B, key, "ssn")
    first = a // 99
    return f"{first + (2 if first >= 665 else 1):03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def ipv4(v: str, key: str) -> str:
    o = list(map(int, v.split(".")))
    a, b = pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ipv4")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def day(v: dt.date, key: str) -> dt.date:
    since = (v - dt.date(1601, 1, 1)).days
    place = since % (pii.DAYS_A * pii.DAYS_B)
    a, b = pair(place // pii.DAYS_B, place % pii.DAYS_B, pii.DAYS_A, pii.DAYS_B, key, "date")
    return v + dt.timedelta(days=a * pii.DAYS_B + b - place)


def card(v: str, key: str) -> str:
    body = v[0] + text(v[1:-1], key, "card", digits)
    return next(body + c for c in pii.DIGITS if luhn(body + c) == 0)


def iban(v: str, key: str) -> str:
    account = text(v[4:], key, "iban", by_class)
    return v[:2] + f"{98 - mod97(account + v[:2] + '00'):02d}" + account


def test_pseudonyms_by_a_second_implementation(spark):
    r, key = random.Random(7), "k"
    want: dict[str, str] = {}
    for _ in range(150):
        v = f"{r.choice([1, 7, 665, 667, 772, 899]):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}"
        want[v] = ssn(v, key)
        v = ".".join(str(r.randint(0, 255)) for _ in range(4))
        want[v] = ipv4(v, key)
        d = dt.date(1900, 1, 1) + dt.timedelta(days=r.randint(0, 60000))
        want[d.strftime("%Y-%m-%d")] = day(d, key).strftime("%Y-%m-%d")
        want[d.strftime("%d.%m.%Y")] = day(d, key).strftime("%d.%m.%Y")
        want[d.strftime("%m/%d/%Y")] = day(d, key).strftime("%m/%d/%Y")
        if d.day > 12:
            to = day(d, key)
            while to.day <= 12:
                to = day(to, key)
            want[d.strftime("%d/%m/%Y")] = to.strftime("%d/%m/%Y")
        v = r.choice("456") + "".join(r.choice(pii.DIGITS) for _ in range(14))
        v = next(v + c for c in pii.DIGITS if luhn(v + c) == 0)
        want[v] = card(v, key)
        v = "".join(r.choice(pii.DIGITS + pii.UPPER) for _ in range(18))
        v = f"GB{98 - mod97(v + 'GB00'):02d}" + v
        want[v] = iban(v, key)
        n = "".join(r.choice(pii.DIGITS) for _ in range(r.randint(7, 14)))
        number = "2" + text(n, key, "e164", digits)
        want["+2" + n] = "+" + number
        spaced = f"+2{n[:1]} {n[1:4]}-{n[4:6]}.{n[6:]}"
        want[spaced] = f"+{number[:2]} {number[2:5]}-{number[5:7]}.{number[7:]}"
        n = r.choice(pii.FIRST) + "".join(r.choice(pii.DIGITS) for _ in range(2)) + r.choice(pii.FIRST) + "".join(r.choice(pii.DIGITS) for _ in range(6))
        m = text(n, key, "phone", phone_digits)
        want[f"({n[:3]}) {n[3:6]}-{n[6:]}"] = f"({m[:3]}) {m[3:6]}-{m[6:]}"
    rows = spark.createDataFrame([(v,) for v in want], "v STRING")
    got = {x["v"]: x["p"] for x in rows.select("v", pii.pseudonymised(F.col("v"), key).alias("p")).collect()}
    assert {v: (got[v], want[v]) for v in want if got[v] != want[v]} == {}
    assert len(set(got.values())) == len(got)


def test_late_days_are_permuted_among_themselves(spark):
    days = [dt.date(1990, 1, 1) + dt.timedelta(days=i) for i in range(4000)]
    rows = spark.createDataFrame([(x.strftime("%d/%m/%Y"),) for x in days if x.day > 12], "v STRING")
    got = [r["p"] for r in rows.select(pii.pseudonymised(F.col("v"), "k").alias("p")).collect()]
    assert len(set(got)) == len(got) and all(int(p[:2]) > 12 for p in got)


def test_dates_before_a_time(spark):
    texts = ["2024-01-05T10:00:00Z", "on 2024-01-05T09:30 and 2024-01-05.", "2024-01-05Tx"]
    rows = spark.createDataFrame([(t,) for t in texts], "v STRING")
    a, b, c = [r["p"] for r in rows.select(pii.pseudonymised(F.col("v"), "k").alias("p")).collect()]
    new = day(dt.date(2024, 1, 5), "k").isoformat()
    assert (a, b, c) == (f"{new}T10:00:00Z", f"on {new}T09:30 and {new}.", texts[2])


def test_shards_by_adding_up(spark):
    r = random.Random(2)
    docs = [(i, None if i % 50 == 0 else "é" * r.choice((0, 1, 30, 400))) for i in r.sample(range(10_000), 700)]
    found = {x["doc_id"]: x for x in shards.by_bytes(spark.createDataFrame(docs, "doc_id LONG, text STRING").repartition(4)).collect()}
    size = {i: len((t or "").encode()) + 1 for i, t in docs}
    before, total, first = 0, sum(size.values()), defaultdict(int)
    for i, t in sorted(docs):
        shard = min(15, (2 * before + size[i]) * 16 // (2 * total))
        assert (found[i]["size"], found[i]["shard"], found[i]["slot"]) == (size[i], shard, first[shard])
        assert found[i]["text_crc32"] == zlib.crc32((t or "").encode())
        first[shard] += 1
        before += size[i]


def test_packing_goes_to_the_cheapest_sequence_with_room():
    r = random.Random(1)
    lengths = [r.choice([1, 5, 100, 700, 1500, 2047, 2048, 5000]) for _ in range(400)]
    rest = sorted(((n % 2048, i) for i, n in enumerate(lengths) if n % 2048), key=lambda x: -x[0])
    k = -(-sum(n for n, _ in rest) // 2048)
    room, load, want, left = [2048] * k, [0.0] * k, {}, []
    for n, i in rest:
        fits = [s for s in range(k) if room[s] >= n]
        if not fits:
            left.append((n, i))
            continue
        s = min(fits, key=lambda s: (load[s], s))
        want[i] = s
        room[s] -= n
        load[s] += 4096 * n + n * n / 2
    found = packing.assign(np.array(lengths))
    full = sum(n // 2048 for n in lengths)
    placed = {i: s - full for i, start, n, s, _ in found if s >= full and n == lengths[i] % 2048}
    assert {i: placed[i] for i in want} == want
    held = defaultdict(float)
    for _, _, n, s, _ in found:
        if s >= full:
            held[s] += packing.cost(n)
    # costs differ by no more than the costliest piece
    assert max(held.values()) - min(held.values()) <= packing.cost(2047)


def test_url_model_by_plain_gradient_steps(spark):
    r = random.Random(4)
    hosts = ["a.net", "shop.example", "news.info"]
    pages = [(h, f"/{r.choice(('buy', 'read', 'cart', 'story'))}/{r.randint(1, 99)}", i % 2) for i, h in enumerate(r.choices(hosts, k=60))]
    pages = sorted(set(pages))

    def grams(host: str, path: str) -> list[int]:
        place = path.translate(str.maketrans("123456789", "000000000")) + "$"
        every = {t + s[i : i + n] for t, s in (("h", f"^{host}$"), ("p", place)) for n in urls.GRAMS for i in range(len(s) - n + 1)}
        return [int(np.uint64(xxhash.xxh64_intdigest(g.encode(), 42)).astype(np.int64)) % urls.BUCKETS for g in sorted(every)]

    rows = [(grams(h, p), y) for h, p, y in pages]
    ones = sum(y for _, y in rows)
    w, squares, bias = np.zeros(urls.BUCKETS), np.full(urls.BUCKETS, 1e-6), math.log(ones / (len(rows) - ones))
    for _ in range(urls.STEPS):
        slope, slope_bias = defaultdict(float), 0.0
        for g, y in rows:
            error = 1 / (1 + math.exp(-(bias + sum(w[b] for b in g) / math.sqrt(len(g))))) - y
            slope_bias += error
            for b in g:
                slope[b] += error / math.sqrt(len(g))
        bias -= slope_bias / len(rows)
        for b, v in slope.items():
            v = v / len(rows) + urls.RIDGE * w[b]
            squares[b] += v * v
            w[b] -= urls.RATE * v / math.sqrt(squares[b])
    weights, found = urls.train(spark.createDataFrame(pages, "host STRING, path STRING, label INT"))
    assert found == pytest.approx(bias, abs=1e-9) and np.allclose(weights, w, atol=1e-9)
