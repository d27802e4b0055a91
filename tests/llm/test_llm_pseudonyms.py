import re

from hypothesis import given
from hypothesis import strategies as st

from packetloom.llm import pseudonyms

TEXTS = {
    1: "mail A.b@x.com, +1 (176) 555-0570 or 176-555-0570. card 4405935324758010 16.120.181.235 end",
    2: "again a.B@x.com: 4405 9353 2475 8010; 4405-9353-2475-8010 16.120.181.235***",
    3: "born 1985-03-07, 29.02.2000 and 12/31/1999",
    4: "IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 ssn 123-45-6789 tel +49 30 901820 x",
}
CLEAN = {
    10: None,
    11: "",
    12: "plain 5 words, 3.14 and 2021-02-30, 300.1.1.1 v 1.2.3.4.5",
    13: "bad 4405935324758011 and DE88370400440532013000 and x4405935324758010y",
    14: "né 12/31 " * 3000,
}


def frame(spark, texts):
    rows = [(k, t, "m", 7) for k, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, matches string, renewed int")


def run(spark, texts, key="k", **options):
    return {r["doc_id"]: r for r in pseudonyms.pseudonymize(frame(spark, texts), key, **options).collect()}


def luhn(digits):
    d = [int(x) for x in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_formats_validations_and_links(spark):
    found = run(spark, TEXTS)
    one, two = found[1]["text"], found[2]["text"]
    for old in ("A.b@x.com", "555-0570", "4405935324758010", "16.120.181.235"):
        assert old not in one + two
    card = re.search(r"\d{16}", one)[0]
    assert card[0] == "4" and luhn(card)
    assert re.search(r"4\d{3} \d{4} \d{4} \d{4}", two)[0].replace(" ", "") == card
    assert re.search(r"4\d{3}-\d{4}-\d{4}-\d{4}", two)[0].replace("-", "") == card
    assert re.search(r"\S+@\S+?(?=[,:])", one)[0] == re.search(r"\S+@\S+?(?=[,:])", two)[0]
    address = re.search(r"\d+\.\d+\.\d+\.\d+", one)[0]
    assert address in two and all(int(x) < 256 for x in address.split("."))
    area, first, last = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", one).groups()
    assert f"or {area}-{first}-{last}." in one
    assert re.fullmatch(r"born \d{4}-\d\d-\d\d, \d\d\.\d\d\.\d{4} and \d\d/\d\d/\d{4}", found[3]["text"])
    code = re.search(r"DE[\d ]+(?= or)", found[4]["text"])[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1
    assert found[1]["n_private"] == 5 and found[4]["private_iban"] == 2 and found[3]["private_date"] == 3
    assert found[1]["matches"] == "m" and found[1]["renewed"] == 7


def test_clean_texts_stay(spark):
    found = run(spark, CLEAN)
    assert {k: r["text"] for k, r in found.items()} == CLEAN
    assert {r["n_private"] for r in found.values()} == {0}


def test_numbers_and_dates_come_back(spark):
    hidden = {k: r["text"] for k, r in run(spark, TEXTS).items()}
    back = run(spark, hidden, restore=True)
    assert back[3]["text"] == TEXTS[3] and back[4]["text"] == TEXTS[4]
    assert back[1]["text"].split(", ", 1)[1] == TEXTS[1].split(", ", 1)[1]
    assert run(spark, hidden, "other key", restore=True)[3]["text"] != TEXTS[3]


def test_permutation_has_no_collisions(spark):
    texts = {i: f"x {i // 100:02d}.{i % 100}.7.9 y" for i in range(2000)}
    found = [r["text"] for r in run(spark, texts).values()]
    assert len(set(found)) == len(texts)


@given(st.integers(0, 10**14 - 1))
def test_luhn_reference(middle):
    body = f"4{middle:014d}"
    assert sum(luhn(body + str(c)) for c in range(10)) == 1


def test_empty_table(spark):
    assert pseudonyms.pseudonymize(frame(spark, {1: "a"}).limit(0), "k").count() == 0


def test_restore_returns_the_very_text(spark):
    days = ("1", "5"), ("9", "9"), ("1", "15"), ("10", "5"), ("01", "5"), ("2", "29"), ("12", "31"), ("02", "29"), ("5", "05")
    dates = [x for m, d in days for y in (1600, 1988, 2020, 9996) for x in (f"{m}/{d}/{y}", f"{d}.{m}.{y}")]
    dates += ["2020-02-29", "1600-01-01", "9999-12-31"]
    texts = {i: f"on {d} it" for i, d in enumerate(dates)}
    texts |= {1000: "ssn 123-45-6789 899-99-9999 001-01-0001 665-10-2000 667-10-2000", 1001: "at 10.0.0.1 or 0.0.0.0 or 255.255.255.255"}
    hidden = {k: r["text"] for k, r in run(spark, texts).items()}
    shape = lambda x: re.sub(r"[0-9]", "9", x)
    for i, d in enumerate(dates):
        assert shape(hidden[i]) == shape(texts[i])
    assert sum(hidden[k] != texts[k] for k in texts) >= len(texts) - 3
    for area, group, serial in re.findall(r"(\d{3})-(\d\d)-(\d{4})", hidden[1000]):
        assert 1 <= int(area) <= 899 and area != "666" and group != "00" and serial != "0000"
    assert {k: r["text"] for k, r in run(spark, hidden, restore=True).items()} == texts


def test_short_dates_have_no_collisions(spark):
    texts = {1000 * y + 31 * m + d: f"{m}/{d}/{2000 + y}" for y in range(12) for m in range(1, 10) for d in range(1, 10)}
    texts |= {900_000 + y: f"2/29/{y}" for y in range(1600, 2000) if y % 4 == 0 and (y % 100 or y % 400 == 0)}
    found = [r["text"] for r in run(spark, texts).values()]
    assert len(set(found)) == len(texts)


def test_numbers_that_are_not_given_out_stay(spark):
    stays = {1: "000-12-3456 666-12-3456 900-12-3456 123-00-4567 123-45-0000", 2: "010.1.1.1 and 1/1/1599 and 2/29/2021 and 13/1/2020"}
    found = run(spark, stays)
    assert {k: r["text"] for k, r in found.items()} == stays and {r["n_private"] for r in found.values()} == {0}


def test_reference_of_the_permutation(spark):
    """The Feistel rounds of an address, recomputed with hashlib."""
    import hashlib

    def number(kind, step, value):
        inner = hashlib.sha256(f"k|{kind}|{step}|{value}".encode()).hexdigest()
        return int(hashlib.sha256(f"k#{inner}".encode()).hexdigest()[:15], 16)

    def address(text):
        a, b, c, d = map(int, text.split("."))
        left, right = a * 256 + b, c * 256 + d
        for step in range(pseudonyms.ROUNDS):
            if step % 2 == 0:
                left = (left + number("ip", step, right) % 65536) % 65536
            else:
                right = (right + number("ip", step, left) % 65536) % 65536
        return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"

    texts = {i: f"{i}.{(i * 7) % 256}.{255 - i}.{i % 10}" for i in range(200)}
    assert {k: r["text"] for k, r in run(spark, texts).items()} == {k: address(t) for k, t in texts.items()}


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(None, "born 1985-03-07", "m", 7), (None, "born 1985-03-07", "m", 7), (1, None, "m", 7)]
    named = spark.createDataFrame(rows, "doc_id long, text string, private_date string, n_private int")
    found = sorted(map(repr, pseudonyms.pseudonymize(named, "k").select("doc_id", "private_date", "n_private").collect()))
    assert found[1] == found[2] and "private_date=1, n_private=1" in found[1] and "private_date=0, n_private=0" in found[0]


LONG = {
    "word": "a" * 1_000_000,
    "dots": "a." * 500_000,
    "host": "x@" + "a." * 500_000 + "com",
    "hosts": "a@" * 500_000,
    "digits": "1" * 1_000_000,
    "capitals": "A" * 1_000_000,
    "pairs": "1-" * 500_000,
    "signs": "+1 " * 333_000,
}


def test_long_words_take_linear_time(spark):
    import time

    run(spark, TEXTS)
    for name, text in LONG.items():
        started = time.time()
        found = run(spark, {1: text})
        assert time.time() - started < 5, name
        assert found[1]["n_private"] == 0 or name == "host", name
