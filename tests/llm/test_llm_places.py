"""Mixing, sharding, archives and the pipeline."""

import base64
import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from packetloom.llm import mixing, sharding, warc
from packetloom.session import shared_path

DOCS = "doc_id long, text string, source string, key string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


# mixing

def filled(sizes, weights=(1, 2, 3), most=3):
    """Targets by handing out the rest again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ones, left = {}, set(names), float(sum(sizes.values()))
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        over = [s for s in open_ones if left * weight[s] / total >= most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_ones}
        for s in over:
            target[s] = float(most * sizes[s])
        left -= sum(target[s] for s in over)
        open_ones -= set(over)
    return target


def some_rows():
    rows = [(i, "w " * (i % 37), ["a", "b", "c", None, "é", "Z"][i % 6]) for i in range(400)]
    return rows + [(900, "x " * 40_000, "hot"), (901, "x", "tiny"), (902, None, "none"), (None, "p q", "a"), (5, "p q", "a"), (5, "p q", "a")]


def test_targets_and_taken_words(spark):
    rows = some_rows()
    found = mixing.mix_sources(frame(spark, rows)).documents.toPandas()
    assert len(found) == len(rows) and (found["taken"] <= 3 * found["size"]).all() and (found["taken"] >= 0).all()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    wanted = filled(dict(sizes))
    for source, part in found.groupby("source", dropna=False):
        name = None if source != source else source
        assert part["source_size"].iloc[0] == sizes[name] and part["target"].iloc[0] == pytest.approx(wanted[name])
        assert abs(part["taken"].sum() - wanted[name]) <= 1
    again = mixing.mix_sources(frame(spark, rows[::-1]).repartition(5)).documents.toPandas()
    order = ["doc_id", "size", "taken"]
    assert again[order].sort_values(order).values.tolist().__repr__() == found[order].sort_values(order).values.tolist().__repr__()


def test_schedule_prefixes_are_near_the_shares(spark):
    plan = mixing.mix_sources(frame(spark, [(i, "w " * 50, "abcd"[i % 4]) for i in range(200)]))
    first = plan.schedule.filter("slot < 1000").groupBy("source_rank").count().collect()
    target = {r["source_rank"]: r["target"] for r in plan.sources.collect()}
    for r in first:
        assert abs(r["count"] / 1000 - target[r["source_rank"]] / sum(target.values())) < 0.01
    slots = plan.schedule.orderBy("source_rank", "rank").collect()
    for a, b in zip(slots, slots[1:]):
        if a["source_rank"] == b["source_rank"]:
            assert (b["rank"], b["begins"]) == (a["rank"] + 1, a["ends"]) and a["slot"] < b["slot"]
            assert abs((a["ends"] - a["begins"]) - a["wanted"] / a["slots"]) < 1
        else:
            assert b["begins"] == 0 and a["ends"] == a["wanted"]


def test_skewed_sources_are_near_their_targets(spark):
    """One large source and many small ones, down to one word: the words that op6 takes of each, and whole documents."""
    rows = [(i, "w " * 400, "large") for i in range(3000)]
    rows += [(10_000 + 100 * s + i, "w " * (1 + s), f"small{s:02d}") for s in range(30) for i in range(1 + s % 7)]
    docs = frame(spark, rows)
    found = mixing.mix_sources(docs, slots=1000).documents.toPandas()
    for source, part in found.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 1, source
        assert (part["taken"] <= 3 * part["size"]).all()
    mixed = Counter()
    for r in mixing.mixed_documents(docs, slots=1000).select("source", "text").collect():
        mixed[r["source"]] += len(r["text"].split())
    for source, part in found.groupby("source"):
        assert abs(mixed[source] - part["target"].iloc[0]) <= part["size"].max(), source


def test_prefixes_of_the_mix_are_near_the_shares(spark):
    docs = frame(spark, [(i, "w " * 20, "abcd"[min(3, i % 7)]) for i in range(7000)])
    plan = mixing.mix_sources(docs)
    target = {r["source"]: r["target"] for r in plan.sources.collect()}
    order = [r["source"] for r in mixing.mixed_documents(docs).select("source").collect()]
    for n in (700, 3500, len(order)):
        for source, words in target.items():
            assert abs(order[:n].count(source) / n - words / sum(target.values())) < 0.02


def test_mixed_documents_repeat_whole_rows(spark):
    docs = frame(spark, some_rows() + [(5, "p q", "b")])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    plan = mixing.mix_sources(docs).documents.toPandas()
    wanted = Counter()
    for r in plan.itertuples():
        uses = sum(r.begins + k * r.source_size < round(r.target + 1e-9) for k in range(3)) if r.size else 0
        wanted[(None if r.doc_id != r.doc_id else r.doc_id, r.source, r.size)] += uses
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mixed.collect())
    assert got == +wanted


def test_sources_below_one_block_are_mixed_to_their_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 16)
    monkeypatch.setattr(mixing, "SLOTS_PER_SOURCE", 0)
    monkeypatch.setattr(mixing.mix_sources, "__defaults__", (*mixing.mix_sources.__defaults__[:-1], 16))
    rows = [(i, "w " * 50, "hot" if i < 2000 else f"s{i % 12:02d}") for i in range(2480)]
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    wanted = filled(dict(sizes))
    taken = Counter()
    for r in mixing.mixed_documents(frame(spark, rows)).collect():
        taken[r["source"]] += 50
    assert all(abs(taken[s] - wanted[s]) <= 50 for s in sizes)


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(frame(spark, [(1, "a", "s")]).limit(0)).documents.count() == 0
    blank = mixing.mix_sources(frame(spark, [(1, None, None), (2, "", "s")])).documents.collect()
    assert {(r["size"], r["taken"], r["target"]) for r in blank} == {(0, 0, 0.0)}


# sharding

def test_places_are_whole_and_equal_on_reruns(spark):
    rows = some_rows() + [(None, "a", "s")] * 5 + [(7, "same", "s")] * 50
    docs = frame(spark, rows)
    placed = sharding.two_pass_shuffle(docs, bucket_bytes=4000)
    assert placed.columns == [*docs.columns, "place_size", "place_shard", "place_slot"]
    found = sharding.shard_digest(placed).toPandas()
    counts = found.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert counts["count"].sum() == len(rows) and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert texts == Counter((None if i != i else i, s, c) for i, s, c in found[["doc_id", "size", "text_crc32"]].itertuples(index=False))
    columns = ["doc_id", "text_crc32", "shard", "slot"]
    again = sharding.shard_digest(sharding.two_pass_shuffle(docs.repartition(7), bucket_bytes=4000)).toPandas()
    assert found[columns].sort_values(columns).to_string(index=False) == again[columns].sort_values(columns).to_string(index=False)
    other = sharding.shard_digest(sharding.two_pass_shuffle(docs, bucket_bytes=4000, seed=1)).toPandas()
    assert (other.sort_values("text_crc32")["slot"].values != found.sort_values("text_crc32")["slot"].values).any()


def test_written_shards_hold_all_rows(spark):
    docs = frame(spark, some_rows())
    written = sharding.write_shards(sharding.two_pass_shuffle(docs), shared_path(spark, "shards"))
    assert written.count() == docs.count() and written.select("place_shard").distinct().count() == 16
    assert sharding.two_pass_shuffle(docs.limit(0)).count() == 0


# archives

PAGES = "page_id long, url string, html string, row string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], PAGES)


def page_rows():
    rows = [(i, f"http://h/{i}?a=%20b", f"<p>{'é' * (i % 5)}{i % 7}</p>") for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "http://x/\r\nEvil: 1", "WARC/1.1\r\n\r\n"), (103, "u", "z" * 900_000)]
    return rows + [(50, "http://again", "<p>1</p>"), (None, "u", "<p>3</p>"), (None, "u", "only"), (200, "t", "tie"), (200, "t", "tie")]


def test_archive_round_trip(spark):
    rows = page_rows()
    index = warc.write_bundles(pages(spark, rows), shared_path(spark, "warc"), frame_bytes=2000, bundle_bytes=3000)
    found = warc.read_bundles(index).collect()
    assert len(found) == len(rows) == index.count() == index.select("record_id").distinct().count()
    best = {}
    for page, _, html in rows:
        best.setdefault(html or "", []).append(-1 if page is None else page)
    for payload, ids in best.items():
        data = payload.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        mine = [r for r in found if r["payload_digest"] == digest]
        first = [r for r in mine if r["record_type"] == "response"]
        assert len(mine) == len(ids) and len(first) == 1 and bytes(first[0]["payload"]) == data
        low = None if max(ids) == -1 else max(ids)
        assert first[0]["page_id"] == low and first[0]["refers_to"] is None
        assert all(r["refers_to"] == low and r["payload"] is None for r in mine if r["record_type"] == "revisit")
        assert {r["payload_bytes"] for r in mine} == {len(data)}
    urls = {r["page_id"]: r["url"] for r in found}
    assert urls[3] == "http://h/3?a=%20b" and urls[100] is None and urls[102] == "http://x/%0D%0AEvil: 1"


def test_references_of_hot_payloads(spark):
    rows = [(i % 70, f"u{i}", ["same page", "other", None, ""][min(3, i % 9)]) for i in range(300)] + [(900 + i, "u", f"own {i}") for i in range(40)]
    path = shared_path(spark, "pages")
    pages(spark, rows + [(None, "u", "same page")]).select("page_id", "url", "html").write.parquet(path)
    stored = spark.read.parquet(path)
    usual, hot = (sorted(map(repr, warc.with_references(stored, n).collect())) for n in (10**6, 2))
    assert usual == hot and len(usual) == 341
    largest = {}
    for r in warc.with_references(stored).collect():
        largest.setdefault(r["html"] or "", set()).add((r["first_page"], r["first_row"]))
    assert all(len(v) == 1 for v in largest.values()) and {p for p, _ in largest["same page"]} == {69}


def test_lookup_reads_single_records(spark):
    index = warc.write_bundles(pages(spark, page_rows()), shared_path(spark, "warc"), frame_bytes=1000)
    wanted = index.orderBy("record_id").limit(5)
    every = {r["record_id"]: r for r in warc.read_bundles(index).collect()}
    assert {r["record_id"]: r for r in warc.lookup(index, wanted).collect()} == {
        r["record_id"]: every[r["record_id"]] for r in wanted.collect()
    }


def test_frames_are_plain_zstandard(spark):
    import zstandard

    index = warc.write_bundles(pages(spark, page_rows()), shared_path(spark, "warc"), frame_bytes=1000)
    name = index.first()["bundle"]
    with open(name.removeprefix("file://"), "rb") as file:
        text = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert text.count(b"WARC-Record-ID") == index.filter(F.col("bundle") == name).count()


def test_no_pages(spark):
    assert warc.archive(pages(spark, [(1, "u", "a")]).limit(0)).count() == 0


# pipeline

def test_stages_of_the_pipeline(spark):
    import corpus_pipeline

    at = str(TESTDATA / "sf0.01")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = spark.read.parquet(_stored(spark, stage(spark, docs, at), name))
        assert docs.columns[: len(columns)] == columns
        sizes.append(docs.count())
        if k < 3:
            assert docs.exceptAll(before).count() == 0
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[4] == sizes[5]
    found = docs.toPandas().groupby("place_shard")["place_slot"].agg(["count", "max"])
    assert (found["max"] + 1 == found["count"]).all() and found["count"].max() - found["count"].min() <= 1


def _stored(spark, df, name):
    path = shared_path(spark, name)
    df.write.parquet(path)
    return path
