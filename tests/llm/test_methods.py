"""Operators against brute force, round trips and planted cases."""

import datetime as dt
import hashlib
import random
import re
import sys
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import prose
from trailframe.llm import chat, decontaminate, language, licenses, linededup, mixing, pii, quality, sharding, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- licenses -------------------------------------------------------------------------------------------------------


def test_license_in_noise(documents):
    notice = licenses.TEMPLATES["BSD-notice"]
    broken = notice.replace("binary", "BINARY ").replace(" ", "\n# ")
    rows = [(1, prose(1, 40) + " " + notice + " " + prose(2, 40), "en", "a"), (2, broken, "en", "a"),
            (3, " ".join(notice.split()[:9]), "en", "a"), (4, prose(3, 500), "en", "a"), (5, f"{notice} {prose(4, 90)} {notice}", "en", "a")]
    got = Counter(r["doc_id"] for r in licenses.scan(documents(rows)).collect())
    assert got == {1: 1, 2: 1, 5: 2}


def test_every_window_of_a_template_is_retrieved(spark):
    known = licenses.template_table(spark, licenses.TEMPLATES)
    texts = known.selectExpr("template as doc_id", "array_join(words, ' ') as text")
    got = licenses.scan(texts).filter("doc_id = template").count()
    assert got == len(licenses.TEMPLATES)


# --- sharding -------------------------------------------------------------------------------------------------------


def check_shards(rows, texts):
    by = defaultdict(list)
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "bytes")
        by[r["shard"]].append(r["slot"])
    assert set(by) <= set(range(40)) and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_are_even(documents):
    copy = prose(0, 150)
    rows = [(i, copy if i % 3 == 0 else prose(i, 30 + i % 90), "en", "a") for i in range(1, 4000)]
    got = sharding.assign(documents(rows)).collect()
    check_shards(got, {r[0]: r[1] for r in rows})
    size, count = Counter(), Counter()
    for r in got:
        size[r["shard"]] += r["size"]
        count[r["shard"]] += 1
    assert max(size.values()) < 1.01 * min(size.values())
    assert max(count.values()) < 1.25 * min(count.values())


def test_cells_add_up(documents, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ITEMS", 500)
    rows = [(i, prose(i, 30 + i % 50), "en", "a") for i in range(2000)]
    got = sharding.assign(documents(rows)).collect()
    check_shards(got, dict((r[0], r[1]) for r in rows))
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    assert max(size.values()) < 1.05 * min(size.values())


def test_long_texts_over_many_cells(documents, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ITEMS", 500)
    rng = random.Random(4)
    texts = [f"{i} " + "a" * rng.randrange(200, 400) for i in range(8000)]
    for k in range(16):  # about half a shard each, far above a cell's share
        texts[k * 480 + 7] = f"{k} " + "b " * 15_000
    got = sharding.assign(documents([(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    held, slots = Counter(), defaultdict(list)
    for r in got:
        held[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(held.values()) / sharding.SHARDS
    assert len(got) == len(texts) and max(held.values()) < 1.02 * mean and min(held.values()) > 0.98 * mean
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_equal_texts_stay_together(spark):
    """Only groups beyond a quarter of a shard are split."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").join(sharding.assign(docs), "doc_id").collect()
    groups, share = defaultdict(list), [sharding.PIECE * x / 40 for x in (sum(r["size"] for r in rows), len(rows))]
    for r in rows:
        groups[r["text"]].append(r)
    split = [g for g in groups.values() if len({r["shard"] for r in g}) > 1]
    assert all(sum(r["size"] for r in g) > share[0] or len(g) > share[1] for g in split)
    assert any(len(g) > 1 and g not in split for g in groups.values())


# --- PII ------------------------------------------------------------------------------------------------------------


def noise(key, kind, i, half):
    return int(hashlib.sha256(f"{key}:{kind}:{i}:{half}".encode()).hexdigest()[:12], 16)


def network(kind, a, b, m, n, key, back=False):
    for i in reversed(range(pii.ROUNDS)) if back else range(pii.ROUNDS):
        sign = -1 if back else 1
        if i % 2 == 0:
            a = (a + sign * noise(key, kind, i, b)) % m
        else:
            b = (b + sign * noise(key, kind, i, a)) % n
    return a, b


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))


def brute_card(value, key):
    d = re.sub(r"\D", "", value)
    if luhn(d) % 10:
        return value
    n = len(d) - 1
    u = n // 2
    a, b = network("card", int(d[:u]), int(d[u:n]), 10**u, 10 ** (n - u), key)
    body = f"{a:0{u}d}{b:0{n - u}d}"
    it = iter(body + str(-luhn(body + "0") % 10))
    return re.sub(r"\d", lambda _: next(it), value)


def brute_ip(value, key):
    o = [int(x) for x in value.split(".")]
    if max(o) > 255:
        return value
    a, b = network("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key)
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def brute_phone(value, key):
    d = re.sub(r"\D", "", value)
    if d[1] < "2" or d[4] < "2":
        return value
    a, b = network("phone", (int(d[1:4]) - 200) * 800 + int(d[4:7]) - 200, int(d[7:]), 640000, 10000, key)
    it = iter(f"1{a // 800 + 200}{a % 800 + 200}{b:04d}")
    return re.sub(r"\d", lambda _: next(it), value)


def brute_date(value, key, back=False):
    try:
        at = (dt.date.fromisoformat(value) - dt.date(1800, 1, 1)).days
    except ValueError:
        return value
    if not 0 <= at < 146097:
        return value
    a, b = network("date", at // 773, at % 773, 189, 773, key, back)
    return (dt.date(1800, 1, 1) + dt.timedelta(days=a * 773 + b)).isoformat()


def brute_ssn(value, key):
    d = re.sub(r"\D", "", value)
    area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return value
    a, b = network("ssn", (area - 1 - (area > 666)) * 99 + group - 1, serial - 1, 898 * 99, 9999, key)
    at = a // 99
    return f"{at + 1 + (at >= 665):03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def brute_email(value, key):
    h = lambda kind, x: hashlib.sha256(f"{key}:{kind}:{x}".encode()).hexdigest()
    return f"{h('name', value.lower())[:12]}@{h('host', value.split('@')[-1].lower())[:8]}.invalid"


def brute_secret(value, key):
    inner = re.search('"(.*)"', value)[1]
    h = lambda kind: hashlib.sha256(f"{key}:{kind}:{inner}".encode()).hexdigest()
    return value.split('"')[0] + '"' + (h("secret") + h("secret2"))[:len(inner)] + '"'


BRUTE = {"email": brute_email, "secret": brute_secret, "ip": brute_ip, "date": brute_date, "ssn": brute_ssn, "phone": brute_phone,
         "card": brute_card}
EDGE = r"[^\W_]"


def brute_text(text, key):
    def one(m):
        for kind, form in pii.FORMS.items():
            if re.fullmatch(form, m[0], re.ASCII):
                return BRUTE[kind](m[0], key)
        return m[0]

    forms = "|".join(f"(?:{f})" for f in pii.FORMS.values()).replace(r"\d", "[0-9]")
    return re.sub(f"(?<!{EDGE})(?:{forms})(?!{EDGE})", one, text)


CASES = ["4465758382889437 4465758382889437", "card 4111-1111-1111-1111, 4111 1111 1111 1112.", "1999-12-31 2024-02-30 0001-01-01 2199-12-31",
         "ssn 078-05-1120 000-12-1234 899-99-9999 667-01-0001", "+1 (743) 555-3824 +1(199) 555-0000", "10.0.0.256 8.8.8.8 255.255.255.255",
         'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" a.b+c@mail.example.org', "x1999-12-31 1999-12-31x 12345678901234567890", "", "378282246310005"]


def test_pii_equals_brute_force(documents, docs):
    rows = docs.unionByName(documents([(10_000 + i, c, "en", "a") for i, c in enumerate(CASES)]).select(docs.columns))
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    for r in pii.report(rows).collect():
        assert r["text"] == brute_text(texts[r["doc_id"]], pii.KEY), texts[r["doc_id"]][:80]


def test_pseudonyms_are_valid_distinct_and_reversible(spark):
    days = [(dt.date(1800, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(0, 146097, 61)]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d string").select(pii.date(pii.F.col("d"), "k")).collect()]
    assert len(set(got)) == len(days) and [brute_date(g, "k", back=True) for g in got] == days
    assert luhn(re.sub(r"\D", "", brute_card("4111 1111 1111 1111", "k"))) % 10 == 0


# --- quality --------------------------------------------------------------------------------------------------------


def test_order_never_changes_the_verdict(docs):
    orders = [quality.RULES, tuple(reversed(quality.RULES))]
    kept = [sorted(r[0] for r in docs.filter(quality.passes(quality.F.col("text"), o)).select("doc_id").collect()) for o in orders]
    assert kept[0] == kept[1] == sorted(r["doc_id"] for r in quality.report(docs).filter("kept").collect())


def test_cascade_puts_rejection_per_cost_first(docs):
    never = quality.Rule("never", lambda t, w: quality.repeat_words(w) < 0)
    order = quality.cascade_order(docs, (never, quality.RULES[0]))
    assert [r.name for r in order] == ["length", "never"]


# --- language -------------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.97
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) for i in got["doc_id"])


def test_gradient(monkeypatch):
    monkeypatch.setattr(language, "HIDDEN", 3)
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in language.fresh(3, rng).items()}
    x, y, mask = rng.integers(0, 5, (7, 4)).astype(np.uint8), np.array([0, 1, 2, 1]), np.ones((7, 4))

    def loss():
        p = language.posteriors(w, x)
        return -np.log(p[:, np.arange(4), y]).mean()

    grad = language._gradients(w, x, y, mask)
    for name, at in (("xzf", (2, 1)), ("hcb", (0, 2)), ("hrf", (1, 1)), ("of", (2, 0)), ("bias", (1,)), ("xcb", (3, 0))):
        keep = w[name][at]
        w[name][at] = keep + 1e-3
        up = loss()
        w[name][at] = keep - 1e-3
        down = loss()
        w[name][at] = keep
        assert abs((up - down) / 2e-3 - grad[name][at]) < 1e-3


def test_whole_texts_count():
    rng = np.random.default_rng(0)
    w = language.fresh(2, rng)
    long = bytes(rng.integers(97, 122, 700_000).astype(np.uint8))
    both = language.pooled(w, [long, long[:1000], b""], 2)
    n = language.WINDOW
    parts = [language.posteriors(w, np.frombuffer(long[k:k + n], dtype=np.uint8)[:, None]).sum(axis=(0, 1)) for k in range(0, 700_000, n)]
    assert np.allclose(both[0], np.sum(parts, axis=0) / 700_000, atol=1e-4) and both[2].sum() == 0


# --- decontamination ------------------------------------------------------------------------------------------------


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bit_parallel_lcs():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 70)), rng.integers(0, 8, rng.integers(0, 90))
        assert decontaminate.lcs(a, b) == brute_lcs(a.tolist(), b.tolist())


def test_recall_against_brute_force(spark):
    """Items found by comparing each item with every stretch of every text, without retrieval."""
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    known, want = [(r["item_id"], decontaminate.tokens(r["text"])) for r in items.collect()], set()
    for r in docs.collect():
        words = decontaminate.tokens(r["text"] or "")
        held = set(words)
        for item, w in known:
            if sum(x in held for x in w) < 0.8 * len(w):
                continue
            n = len(w)
            for at in range(0, max(1, len(words) - n), max(1, n // 2)):
                if decontaminate.lcs(*(np.array([hash(x) for x in y]) for y in (w, words[at:at + 2 * n]))) >= 0.8 * n:
                    want.add((r["doc_id"], item))
                    break
    assert want and len(got & want) >= 0.9 * len(want)
    assert len(got - want) <= 0.1 * len(got)


def test_paraphrase_needs_the_answer(documents, spark):
    question = "which of the seven painted rivers crosses the northern desert before reaching the capital city gate"
    item = f"{question}? The answer is the crimson river Ostrava."
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    changed = question.replace("seven", "eight").replace("northern", "southern").replace("capital", "old").replace("painted", "drawn")
    rows = [(1, f"{prose(1, 60)} {changed}? The answer is the crimson river Ostrava. {prose(2, 60)}", "en", "a"),
            (2, f"{prose(3, 60)} {changed}? Nobody has ever known. {prose(4, 60)}", "en", "a"),
            (3, f"{prose(5, 300)} {item} {prose(6, 40)}", "en", "a"), (4, prose(7, 3000), "en", "a")]
    got = {r["doc_id"]: r["copied"] for r in decontaminate.leaks(documents(rows), items).collect()}
    assert got.keys() == {1, 3} and got[3]


def test_paraphrase_of_a_single_sentence(documents, spark):
    frame = "which of the seven painted {} {} rivers crosses {} the northern {} desert before {} reaching {} city {} gate"
    item = frame.format("ostrava", "velmora", "quintel", "zarbeth", "lomerin", "tarvid", "ubresk")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    changed = item.replace("seven", "nine").replace("painted", "drawn").replace("northern", "dry").replace("reaching", "its").replace("gate", "door")
    other = frame.format("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta")
    rows = [(1, f"{prose(1, 60)} {changed}. {prose(2, 60)}", "en", "a"), (2, f"{prose(3, 60)} {other}. {prose(4, 60)}", "en", "a")]
    rows += [(k, f"{prose(k, 60)} gate city reaching before desert northern crosses rivers painted seven which", "en", "a") for k in range(10, 14)]
    got = {r["doc_id"]: r["copied"] for r in decontaminate.leaks(documents(rows), items).collect()}
    assert got == {1: False}


def test_every_verbatim_copy_is_found(documents, spark, monkeypatch):
    """Short, common-word, long and many items, each word for word in the middle of other text."""
    rng = random.Random(11)
    common = "the of and to in a is".split()
    texts = ["Is it 42?", "Ostrava", "to be or not", "is the a of to in and the of a", " ".join(rng.choices(common, k=40)), prose(50, 400)]
    texts += [f"{prose(100 + k, 6 + k % 50, 300)}." for k in range(60)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(k, f"{prose(200 + k, 37 + k, 90)} {t} {prose(300 + k, 90, 90)}", "en", "a") for k, t in enumerate(texts)]
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 40)
    docs = documents(rows)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).filter("copied").collect()}
    assert {(k, k) for k in range(len(texts))} <= got
    monkeypatch.setattr(decontaminate, "MIN_COSINE", 2.0)  # the exact retrieval alone
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).filter("copied").collect()} == got


def test_blocks_cover_the_benchmark(spark, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 20)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()} == whole != set()


def searcher(texts):
    block = decontaminate.Block.of([(str(k), t) for k, t in enumerate(texts)])
    size = len(block.vocabulary)
    seen = np.arange(size) % 7 + 1
    return decontaminate.Searcher(block, decontaminate.term_weights(block, seen, 1000), np.eye(size), seen)


def test_search_equals_verification_of_every_passage():
    """Nothing that verification accepts anywhere is put aside by the cosine, the rare words or the counts around passages."""
    rng, words = random.Random(21), [f"k{i}" for i in range(30)]
    search = searcher([" ".join(rng.choices(words, k=n)) for n in (1, 2, 4, 5, 5, 6, 7, 9, 12, 12, 20, 33, 70)])
    found = 0
    for _ in range(150):
        parts = [rng.choices([*words[:rng.randint(1, 30)], "a", "b"], k=rng.randint(0, 90)) for _ in range(rng.randint(1, 4))]
        for part in parts:  # most of an item, with some words changed
            item = [words[int(x) % 30] if rng.random() < 0.1 else list(search.block.vocabulary)[x].decode() for x in rng.choice(search.block.words)]
            part[rng.randint(0, len(part)):0] = item if rng.random() < 0.7 else []
        numbers, want = search.block.numbers(" ".join(x for p in parts for x in p)), {}
        for at in decontaminate.starts(len(numbers)).tolist() if len(numbers) else []:
            for k, item in enumerate(search.block.words):
                n = len(item)
                around = numbers[max(0, at - n):at + decontaminate.PASSAGE + n]
                score = decontaminate.lcs(item, around) / n
                answered = decontaminate.lcs(search.answers[k], around) >= decontaminate.ANSWER * len(search.answers[k])
                whole = n >= decontaminate.MIN_ITEM_WORDS or decontaminate.run_at(item, around)
                if whole and score >= (decontaminate.PARAPHRASE if answered else decontaminate.COPY) and score > want.get(str(k), (0,))[0]:
                    want[str(k)] = score, score >= decontaminate.COPY, at
        got = {x["item"]: (x["score"], x["copied"], x["word"]) for x in search.search(numbers)}
        assert got == want
        found += len(want)
    assert found > 150


def test_numbers_of_many_texts_equal_those_of_each():
    block = decontaminate.Block.of([("1", "Alpha beta, gamma's delta 漢字"), ("2", "alpha Ünï x")])
    rng, parts = random.Random(4), ["alpha", "BETA", "s", "漢字", "Ünï", "other", " ", "\n", "\t", "--", "\x00", ".", "\u00a0", "\ud800", "é"]
    texts = [None, "", "   ", "...", "alpha", *("".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(300))]
    want = [block.numbers(t).tolist() for t in texts]
    got = block.packed([decontaminate.separated(t) for t in texts])
    assert [decontaminate.unpacked(x).tolist() for x in got] == want and max(map(len, want)) > 5
    assert block.packed([]) == []


def test_passages_with_too_few_words_cost_no_calls_of_their_own():
    """A text that holds all words of an item, but never enough of them together, is searched in few calls, however long it is."""
    words = [f"k{i}" for i in range(10)]
    search = searcher([" ".join(words)])
    numbers = search.block.numbers(" ".join(f"{a} {b} " * 800 for a, b in zip(words[::2], words[1::2], strict=True)))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = search.search(numbers)
    finally:
        sys.setprofile(None)
    assert got == [] and calls < len(decontaminate.starts(len(numbers))) == 499


# --- SimHash --------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids, root = sorted(prints), {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("cell", [8192, 8])
def test_simhash_equals_brute_force(spark, documents, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "SMALL", 4)
    monkeypatch.setattr(simhash, "TILE", 16)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 600").select("doc_id", "text")
    more = documents([(1000 + i, f"{prose(5, 400)} end {i % 40} {i % 7}", "en", "a") for i in range(120)] + [(2000, None, "en", "a"), (2001, " ", "en", "a")])
    docs = docs.unionByName(more.select("doc_id", "text"))
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    want = brute_components(prints)
    for r in simhash.near_duplicates(docs).collect():
        assert int(r["fingerprint"], 16) == prints[r["doc_id"]] and len(r["fingerprint"]) == 16
        assert r["component_id"] == want[r["doc_id"]]


def test_long_chain_is_one_component(spark):
    from trailframe.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


# --- chat -----------------------------------------------------------------------------------------------------------


def test_folding_events(spark):
    events = [(1, 1, 1, "message", "user", "helo"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "Hi "),
              (1, 4, 2, "delta", None, "there"), (1, 5, 1, "edit", "user", "hello"), (1, 6, 3, "message", "user", "more"),
              (1, 7, 2, "regenerate", "assistant", None), (1, 8, 2, "delta", None, "Good "), (1, 9, 2, "delta", None, "day"),
              (1, 10, 3, "message", "user", "thanks <|im_end|>\n\\g")]
    log = spark.createDataFrame(events, "conv_id long, seq long, slot long, kind string, role string, text string")
    got = [(r["slot"], r["role"], r["text"]) for r in chat.fold(log).orderBy("slot").collect()]
    assert got == [(1, "user", "hello"), (2, "assistant", "Good day"), (3, "user", "thanks <|im_end|>\n\\g")]
    dropped = chat.fold(log.filter("seq < 10")).orderBy("slot").collect()
    assert [(r["slot"], r["text"]) for r in dropped] == [(1, "hello"), (2, "Good day")]
    row = chat.render(chat.fold(log)).select("*", chat.parse(chat.F.col("formatted")).alias("turns"),
                                             chat.learned_text(chat.F.col("formatted"), chat.F.col("loss")).alias("learned")).first()
    assert [(t["role"], t["text"]) for t in row["turns"]] == [g[1:] for g in got] and row["learned"] == "Good day"


# --- line dedup -----------------------------------------------------------------------------------------------------


def test_repeated_passages_are_cut(documents):
    passage = prose(99, 60).replace("\n", " ")
    lines = "\n".join(prose(98, 12).replace("\n", " ") for _ in range(1)) + "\n" + "\n".join(f"{prose(200 + k, 9).strip()}" for k in range(8))
    rows = [(i, f"{prose(i, 90)}\n{passage}\n{prose(1000 + i, 50)}", "en", "a") for i in range(1, 30)]
    rows += [(i, f"{lines}\n{prose(i, 60)}\n{lines}", "en", "a") for i in (40, 41)]
    rows += [(50 + i, prose(300 + i, 200), "en", "a") for i in range(5)]
    got = {r["doc_id"]: r for r in linededup.report(documents(rows)).collect()}
    texts = dict((r[0], r[1]) for r in rows)
    assert got[1]["text"] == texts[1] and all(got[50 + i]["text"] == texts[50 + i] for i in range(5))
    for i in range(2, 30):
        assert passage not in got[i]["text"] and prose(i, 90).strip() in got[i]["text"] and prose(1000 + i, 50) in got[i]["text"]
    assert got[40]["text"].count(lines) == 1 and lines not in got[41]["text"] and prose(41, 60).strip() in got[41]["text"]


def brute_units(texts):
    """Units of later runs, from all grams of all texts without winnowing."""
    seen, cut = {}, {}
    for i in sorted(texts):
        h, n = (x.tolist() for x in linededup.units(texts[i] or "")[:2])
        cut[i] = set()
        for a in range(len(h)):
            total, b = 0, a
            while n[a] and b < len(h) and total < linededup.GRAM_WORDS:
                total += n[b]
                b += 1
            if total >= linededup.GRAM_WORDS:
                if seen.setdefault(tuple(h[a:b]), (i, a)) != (i, a):
                    cut[i] |= set(range(a, b))
    return cut


def test_cuts_are_those_of_all_grams(docs):
    """Runs of 40 words or more are cut in full; of the shorter ones, below the guarantee, some have no fingerprint."""
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = brute_units(texts)
    found = {r["id"]: {u for a, b in zip(r["begin"], r["end"], strict=True) for u in range(a, b)} for r in linededup.spans(docs).collect()}
    long, missed_short = 0, 0
    for i, units in want.items():
        words, cut = linededup.units(texts[i] or "")[1], found.get(i, set())
        starts = [u for u in sorted(units) if u - 1 not in units]
        for u in starts:
            run = []
            while u in units:
                run.append(u)
                u += 1
            if sum(words[run]) >= 40:
                long += len(run)
                assert set(run) <= cut, (i, run)
            else:
                missed_short += len(set(run) - cut)
    total = sum(map(len, want.values()))
    extra = sum(len(found[i] - want[i]) for i in found)
    assert long > 0.8 * total > 50 and missed_short <= 0.1 * total and extra <= 0.05 * total
    dropped = {r["doc_id"]: r["n_dropped"] for r in linededup.report(docs).collect()}
    assert all(dropped[i] == len(found.get(i, ())) for i in dropped)


def word_runs(texts, least):
    """(text, first word, end) of maximal runs of ``least`` words or more that an earlier place holds; from words alone."""
    seen, out = {}, []
    for i in sorted(texts):
        words = (texts[i] or "").split()
        old = [seen.setdefault(tuple(words[a:a + least]), (i, a)) != (i, a) for a in range(max(0, len(words) - least + 1))]
        a = 0
        while a < len(old):
            b = a
            while b < len(old) and old[b]:
                b += 1
            if b > a:
                out.append((i, a, b - 1 + least))
            a = max(b, a + 1)
    return out


def test_passages_are_cut_wherever_they_stand(documents):
    """In mid-sentence, without punctuation, under null and repeated ids; against word runs that know nothing of units."""
    bare = lambda seed, n: " ".join(prose(seed, n).replace(".", "").split())
    passage, dotted = bare(900, 80), " ".join(prose(901, 80).split())
    rows = [(1, f"{bare(1, 70)} {passage} {bare(2, 33)}"), (2, f"{bare(3, 41)} {passage} {bare(4, 90)}"), (3, f"x {dotted} y"), (4, f"{bare(5, 30)} {dotted} z w"),
            (None, f"{bare(6, 25)} {passage}"), (None, f"{passage} {bare(7, 60)}"), (5, bare(8, 90)), (5, f"{bare(9, 20)} {dotted}"), (5, bare(10, 77))]
    got = {r["text"] for r in linededup.report(documents([(i, t, "en", "a") for i, t in rows])).collect()}
    texts = {k: t for k, (i, t) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))}
    runs = word_runs(texts, 50)
    assert len(runs) == 5
    assert {rows[0][1], rows[2][1], rows[6][1], rows[8][1]} <= got  # first occurrences and texts of their own
    for i, a, b in runs:
        words = texts[i].split()
        left = max((t for t in got if " ".join(words[:max(0, a - 1)]) in t and " ".join(words[b + 1:]) in t), key=len, default=None)
        assert left is not None, (i, a, b)
    for t in got - {rows[0][1], rows[2][1]}:
        assert not any(" ".join(p.split()[k:k + 40]) in " ".join(t.split()) for p in (passage, dotted) for k in range(0, 41, 5))


def test_many_null_ids_and_equal_rows(documents):
    one = prose(77, 120)
    rows = [(None, one, "en", "a")] * 300 + [(None, f"{prose(500 + k, 30)} {one}", "en", "a") for k in range(40)] + [(3, one, "en", "a")] * 50
    got = Counter(r["text"] for r in linededup.report(documents(rows)).collect())
    assert got[one] == 50 and sum(got.values()) == 390 and sum(n for t, n in got.items() if not t) == 300


def test_hashes_do_not_depend_on_the_place():
    a, b = prose(5, 90), prose(6, 90)
    alone, later = linededup.units(a), linededup.units(f"é 漢字\n{b}\n{a}")
    assert set(alone[0].tolist()) <= set(later[0].tolist()) and sum(later[1]) == 2 + 90 + 90
    assert later[2][-1] == len(f"é 漢字\n{b}\n{a}".encode()) and len(linededup.units(" \n")[0]) == 0


# --- rows without an id of their own ----------------------------------------------------------------------------------


def test_shards_of_rows_without_ids(documents):
    """Copies under a null id, or under one repeated id, are spread like any others."""
    rows = [(None, "one text", "en", "a")] * 2000 + [(7, "another text of some words", "en", "a")] * 2000
    got = Counter(r["shard"] for r in sharding.assign(documents(rows)).collect())
    assert sum(got.values()) == 4000 and len(got) == 40 and min(got.values()) > 50 and max(got.values()) < 160


@pytest.mark.parametrize("cell_items", [400, 40])
def test_small_groups_stay_whole_in_any_number_of_cells(documents, monkeypatch, cell_items):
    monkeypatch.setattr(sharding, "CELL_ITEMS", cell_items)
    monkeypatch.setattr(sharding, "FAN", 4)
    rows = [(i, prose(i % 2000, 40), "en", "a") for i in range(4000)] + [(5000 + i, prose(9999, 40), "en", "a") for i in range(20)]
    docs = documents(rows)
    got = docs.select("doc_id", "text").join(sharding.assign(docs), "doc_id").collect()
    shards, held = defaultdict(set), Counter()
    for r in got:
        shards[r["text"]].add(r["shard"])
        held[r["shard"]] += r["size"]
    assert len(got) == 4020 and all(len(s) == 1 for s in shards.values())
    assert max(held.values()) < 1.15 * min(held.values())


def test_mixture_of_rows_without_ids(documents):
    """Half of the tokens are half of the rows, whether or not ids tell rows apart."""
    for ids in (range(110), [None] * 110, [3] * 110):
        for text in (lambda i: f"a b c w{i}", lambda i: "a b c d"):
            docs = documents([(x, text(i), "en", "src0") for i, x in enumerate(ids)])
            assert len(mixing.mixture(docs, fraction=0.5, max_epochs=1).collect()) == 55
    assert mixing.select_documents(docs, 0.5).count() == 55


def test_language_answers_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    w = language.fresh(3, rng)
    raw = [bytes(rng.integers(97, 122, n).astype(np.uint8)) for n in (1, 40, 255, 256, 257, 700)]
    together = language.pooled(w, raw, 3)
    for text, p in zip(raw, together, strict=True):
        assert np.allclose(language.pooled(w, [text], 3)[0], p, atol=1e-6)


def test_language_training_ignores_padding():
    rng = np.random.default_rng(4)
    w, y, size = language.fresh(2, rng), np.array([0, 1]), np.array([5, 3])
    x = rng.integers(97, 122, (5, 2)).astype(np.uint8)
    grads = []
    for steps in (5, 9):
        padded, mask = np.zeros((steps, 2), np.uint8), (np.arange(steps)[:, None] < size).astype(np.float32)
        padded[:5] = x * (np.arange(5)[:, None] < size)
        grads.append(language._gradients(w, padded, y, mask))
    for name in grads[0]:
        assert np.allclose(grads[0][name], grads[1][name], atol=1e-6)


def test_license_rows_without_ids(documents):
    """Rows with a null or repeated id are texts of their own: parts don't add up, copies report each."""
    notice = licenses.TEMPLATES["MIT-notice"].split()
    halves = [" ".join(notice[:15]), " ".join(notice[12:])]
    assert licenses.scan(documents([(None, t, "en", "a") for t in halves])).count() == 0
    got = licenses.scan(documents([(i, " ".join(notice), "en", "a") for i in (None, None, 3, 3, 4)])).collect()
    assert Counter((r["doc_id"], r["template"]) for r in got) == {(None, "MIT-notice"): 2, (3, "MIT-notice"): 2, (4, "MIT-notice"): 1}


def test_latent_directions_cover_all_documents(spark, documents):
    """Subspace iteration over every passage of 2300 documents, none left out, equals the direct computation."""
    rng = random.Random(3)
    words = [f"k{i}" for i in range(40)]
    items = spark.createDataFrame([(str(i), " ".join(rng.choices(words, k=12))) for i in range(6)], "item_id string, text string")
    texts = [" ".join(rng.choices(words[:1 + i % 40] + ["a", "b", "c"] * 20, k=rng.choice([1, 5, 33, 47, 48, 49, 90]))) for i in range(2300)]
    search = next(decontaminate.searchers(documents([(i, t, "en", "src0") for i, t in enumerate(texts)] + [(9999, None, "en", "src0")]), items))
    search = search[0] if isinstance(search, tuple) else search
    block, n = search.block, len(texts) + 1
    numbers = [block.numbers(t) for t in texts]
    seen = np.array([sum(k in set(x.tolist()) for x in numbers) for k in range(len(block.vocabulary))])
    idf = decontaminate.term_weights(block, seen, n)
    passages = block.words + [x[s:s + decontaminate.PASSAGE] for x in numbers for s in decontaminate.starts(len(x))]
    a = np.array([np.bincount(p[p >= 0], minlength=len(idf)) * idf for p in passages])
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    width = min(decontaminate.SKETCH, len(idf))
    q = np.linalg.qr(np.random.default_rng(decontaminate.SEED).normal(size=(len(idf), width)))[0]
    for _ in range(2):
        y = a.T @ (a @ q)
        q = np.linalg.qr(y @ np.linalg.eigh((q.T @ y + y.T @ q) / 2)[1][:, ::-1])[0]
    assert np.allclose(np.abs(search.table[:, :5]), np.abs(idf[:, None] * q[:, :5]), atol=1e-3)
