"""PII: keyed format-preserving pseudonyms for validated numbers and dates.

One pattern finds candidates in whole texts; each is validated (Luhn sum, number ranges, calendar) and only then replaced.
The replacement is an alternating Feistel network over two residues whose product is exactly the number of valid values, so
every pseudonym is a valid value of the same format and two values never share one:

* card numbers: all digits but the last are permuted and the check digit is computed anew;
* social security numbers: 898 areas x 99 groups, and 9999 serials;
* phone numbers: 800 x 800 area and exchange codes, and 10 000 lines;
* IPv4 addresses: 65 536 x 65 536;
* dates (ISO): the 146 097 days from 1800-01-01 to 2199-12-31 as 189 x 773.

Round values come from SHA-256 of key, kind, round and half, hence equal values stay linked across documents and runs. The
local part and domain of e-mail addresses and quoted secrets aren't numbers; they get keyed SHA-256 text instead, of the
secret's length. Addresses have at most 64 characters before the @ and 20 labels after it.

Defined cases: a null text stays null, an empty one empty; invalid candidates stay as they are; repeated rows give equal
rows; ids may be null; an empty table gives no rows. ``pseudonymise`` keeps all other columns. The key must be kept secret:
with it the permutation can be undone (``restore`` in the tests does so).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe.llm.common import let

#: Demonstration key of the registered query; pass your own.
KEY = "change-this-key"
ROUNDS = 8
EDGE_L, EDGE_R = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
FORMS = {
    # Every part is bounded or possessive, and no candidate starts inside a run of its own characters: linear on any text.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,20}[A-Za-z]{2,63}+",
    "secret": r"(?i:token|secret|password|api_key) ?[=:] ?\"[A-Za-z0-9+/_-]{16,}+\"",
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}",
    "date": r"\d{4}-\d{2}-\d{2}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": r"\+1 ?\(\d{3}\) ?\d{3}-\d{4}",
    "card": r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19}",
}
PATTERN = f"{EDGE_L}(?:" + "|".join(FORMS.values()) + f"){EDGE_R}"
EXACT = {kind: f"^(?:{form})$" for kind, form in FORMS.items()}


def feistel(kind: str, left: Column, right: Column, m: Column | int, n: Column | int, key: str) -> Column:
    """Permutes pairs (left in 0..m-1, right in 0..n-1); gives a struct (a, b)."""
    m, n = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (m, n))

    def noise(i: Column, half: Column) -> Column:
        digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, (s["a"] + noise(i, s["b"])) % m).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise((s["b"] + noise(i, s["a"])) % n).alias("b"))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum with the last digit undoubled."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) % 10 + F.when(c.cast("int") > 4, 1).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x)


def refill(shape: Column, digits: Column) -> Column:
    """``digits`` put into the digit places of ``shape``."""
    places = F.sequence(F.lit(1), F.length(shape))
    return F.array_join(F.transform(places, lambda i: F.when(
        F.substring(shape, i, F.lit(1)).rlike("[0-9]"),
        F.substring(digits, F.length(digits_of(F.substring(shape, F.lit(1), i))), F.lit(1)),
    ).otherwise(F.substring(shape, i, F.lit(1)))), "")


def part(digits: Column, start: int, length: int) -> Column:
    return F.substring(digits, start, length).cast("long")


def pad(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def card(value: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        size = F.length(d) - 1
        cut = F.floor(size / 2).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("long")  # noqa: E731  exact up to 10^9

        def joined(s: Column) -> Column:
            body = F.concat(pad(s["a"], cut), pad(s["b"], size - cut))
            return let(body, lambda x: F.concat(x, ((10 - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))

        halves = feistel("card", F.substring(d, F.lit(1), cut).cast("long"),
                         F.substring(d, cut + 1, size - cut).cast("long"), ten(cut), ten(size - cut), key)
        return F.when(luhn_sum(d) % 10 == 0, refill(value, let(halves, joined))).otherwise(value)

    return let(digits_of(value), made)


def ssn(value: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        area, group, serial = part(d, 1, 3), part(d, 4, 2), part(d, 6, 4)
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        place = area - F.when(area > 666, 2).otherwise(1)

        def joined(s: Column) -> Column:
            at = F.floor(s["a"] / 99).cast("long")
            return F.concat(pad(at + F.when(at >= 665, 2).otherwise(1), 3), pad(s["a"] % 99 + 1, 2), pad(s["b"] + 1, 4))

        halves = feistel("ssn", place * 99 + group - 1, serial - 1, 898 * 99, 9999, key)
        return F.when(valid, refill(value, let(halves, joined))).otherwise(value)

    return let(digits_of(value), made)


def phone(value: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        area, exchange, line = part(d, 2, 3), part(d, 5, 3), part(d, 8, 4)
        halves = feistel("phone", (area - 200) * 800 + exchange - 200, line, 640_000, 10_000, key)
        joined = lambda s: F.concat(F.lit("1"), pad(F.floor(s["a"] / 800).cast("long") + 200, 3),
                                    pad(s["a"] % 800 + 200, 3), pad(s["b"], 4))
        return F.when((area >= 200) & (exchange >= 200), refill(value, let(halves, joined))).otherwise(value)

    return let(digits_of(value), made)


def ip(value: Column, key: str) -> Column:
    def made(o: Column) -> Column:
        n = [F.get(o, i).cast("long") for i in range(4)]
        valid = F.lit(True)
        for x in n:
            valid = valid & (x < 256)
        halves = feistel("ip", n[0] * 256 + n[1], n[2] * 256 + n[3], 65_536, 65_536, key)
        joined = lambda s: F.concat_ws(".", F.floor(s["a"] / 256).cast("string"), (s["a"] % 256).cast("string"),
                                       F.floor(s["b"] / 256).cast("string"), (s["b"] % 256).cast("string"))
        return F.when(valid, let(halves, joined)).otherwise(value)

    return let(F.split(value, r"\."), made)


def date(value: Column, key: str) -> Column:
    first = F.lit("1800-01-01").cast("date")

    def made(day: Column) -> Column:
        place = F.datediff(day, first).cast("long")
        halves = feistel("date", F.floor(place / 773).cast("long"), place % 773, 189, 773, key)
        joined = lambda s: F.date_add(first, (s["a"] * 773 + s["b"]).cast("int")).cast("string")
        return F.when(day.isNotNull() & (place >= 0) & (place < 146_097), let(halves, joined)).otherwise(value)

    return let(value.try_cast("date"), made)


def keyed_text(kind: str, value: Column, key: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), value), 256)


def email(value: Column, key: str) -> Column:
    host = F.substring_index(value, "@", -1)
    name = F.substring(keyed_text("name", F.lower(value), key), 1, 12)
    return F.concat(name, F.lit("@"), F.substring(keyed_text("host", F.lower(host), key), 1, 8), F.lit(".invalid"))


def secret(value: Column, key: str) -> Column:
    inner = F.regexp_extract(value, '"(.*)"', 1)
    blocks = F.transform(F.sequence(F.lit(1), F.ceil(F.length(inner) / 64).cast("int")), lambda i: F.sha2(
        F.concat_ws(":", F.lit(key), F.concat(F.lit("secret"), F.when(i > 1, i.cast("string")).otherwise("")), inner), 256))
    masked = F.substring(F.array_join(blocks, ""), F.lit(1), F.length(inner))
    return F.concat(F.substring_index(value, '"', 1), F.lit('"'), masked, F.lit('"'))


MAKERS: dict[str, Callable[[Column, str], Column]] = {
    "email": email, "secret": secret, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card}


def pseudonym(value: Column, key: str) -> Column:
    """The replacement of one candidate, itself if it isn't valid."""
    chain = None
    for kind, make in MAKERS.items():
        fits = value.rlike(EXACT[kind])
        chain = F.when(fits, make(value, key)) if chain is None else chain.when(fits, make(value, key))
    return chain.otherwise(value)


def candidates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def replaced(text: Column, key: str) -> Column:
    """Struct (text, n) of the new text and the number of replaced values."""

    def rebuilt(found: Column) -> Column:
        new = F.transform(found, lambda x: pseudonym(x, key))

        def woven(fresh: Column) -> Column:
            gaps = F.split(text, PATTERN, -1)
            joined = F.array_join(F.zip_with(gaps, fresh, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
            n = F.size(F.filter(F.zip_with(found, fresh, lambda a, b: a != b), lambda x: x))
            return F.struct(joined.alias("text"), n.cast("long").alias("n"))

        return F.when(F.size(found) > 0, let(new, woven)).otherwise(F.struct(text.alias("text"), F.lit(0).cast("long").alias("n")))

    return let(candidates(text), rebuilt)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every validated value in ``text`` replaced; other columns as they are."""
    return docs.withColumn("text", replaced(F.col("text"), key)["text"])


def report(docs: DataFrame, key: str = KEY) -> DataFrame:
    return docs.select("doc_id", replaced(F.col("text"), key).alias("__new")).select(
        "doc_id", F.col("__new.text").alias("text"), F.coalesce(F.col("__new.n"), F.lit(0)).cast("long").alias("n_replaced"))
