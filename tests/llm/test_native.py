"""WARC archives, mixing, URL rules: given tables against SQL, small tables against plain code."""

import random
import re
import struct
from collections import defaultdict

import compare
import pytest
import zstandard

from sheafline.llm import checks, mixing, queries, urlrules, warc


@pytest.mark.parametrize("name", list(checks.SQL))
def test_query_matches_sql(spark, sf, name):
    assert not compare.differences(queries.QUERIES[name](spark, sf), compare.connect(sf), checks.SQL[name])[:3]


# ---- URL rules ----------------------------------------------------------------------------------

def judge(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_rules_against_plain_search(spark):
    rng = random.Random(5)
    labels, parts = ["a", "b", "com", "x-y", "é"], ["/", "/a", "/a/", "/a/b", "/é", "/ab", ""]
    rules = list({(".".join(rng.choices(labels, k=rng.randint(1, 3))), rng.choice(parts)): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{'.'.join(rng.choices(labels, k=rng.randint(1, 5)))}{rng.choice(parts)}{rng.choice(['', 'b', '/b?c', '#x', '?a://b'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "http://", "HTTP://A.COM/a", "x://a.com?q://b", "http://a.com:80/a", "http://" + "a." * 200 + "com/a", "http://a.com/" + "a" * 50_000]
    rows = [(i, u, "x", 1) for i, u in enumerate(urls)] + [(3, urls[3], "x", 1)] * 2
    table = spark.createDataFrame(rows, "page_id LONG, url STRING, host STRING, part INT")
    got = urlrules.judge(table, spark.createDataFrame(rules, "host STRING, path STRING, verdict STRING")).collect()
    assert sorted(map(tuple, got)) == sorted(((i, *judge(u, rules)) for i, u, _, _ in rows), key=lambda r: r) if all(r[3] for r in got) else \
        sorted((tuple(r) for r in got), key=repr) == sorted(((i, *judge(u, rules)) for i, u, _, _ in rows), key=repr)


def test_odd_rule_tables(spark):
    table = spark.createDataFrame([(1, "http://A.com/x"), (None, "http://b.com/")], "page_id LONG, url STRING")
    schema = "host STRING, path STRING, verdict STRING"
    none = urlrules.judge(table, spark.createDataFrame([], schema)).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in none} == {(1, None, "allow"), (None, None, "allow")}
    twice = [("COM", "/", "allow"), ("com", "/", "block"), (None, "/", "block"), ("b.com", None, "block")]
    got = urlrules.judge(table, spark.createDataFrame(twice, schema)).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in got} == {(1, "com/", "block"), (None, "com/", "block")}
    assert urlrules.judge(table.limit(0), spark.createDataFrame(twice, schema)).collect() == []


# ---- mixing -------------------------------------------------------------------------------------

def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by rounds, as the rule states them."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, out, full = share * sum(sizes.values()), {}, set()
    while True:
        left = goal - sum(2.0 * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else left * weight[s] / total for s in order}
        over = {s for s in order if s not in full and out[s] > 2.0 * sizes[s]}
        if not over:
            return out
        full |= over


def mixed(spark, rows):
    table = spark.createDataFrame([(*r, 7, 0.5) for r in rows], "doc_id LONG, text STRING, source STRING, size INT, target DOUBLE")
    return mixing.mix(table)


def check_mix(got, rows, slack):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = targets(size), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= slack, (s, taken[s], t)


def test_mix_reaches_targets_and_agrees(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 80), rng.choice(["a", "b", "b", "b", "B", "é", "z", None])) for i in range(400)] + [(500, "tiny one", "rare")]
    first, again = (mixed(spark, rows)["documents"].collect() for _ in range(2))
    check_mix(first, rows, 3)
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)


def test_mix_in_large_blocks(spark, monkeypatch):
    """Blocks of many words: any stretch of the schedule holds every source in its share."""
    monkeypatch.setattr(mixing, "SLOTS", 1 << 10)
    monkeypatch.setattr(mixing, "BUCKETS", 1 << 4)
    rows = [(i, "w " * (50 + i % 40), "abc"[i % 3]) for i in range(900)]
    out = mixed(spark, rows)
    check_mix(out["documents"].collect(), rows, 2 * 100 * 3)
    slots = sorted(out["schedule"].collect(), key=lambda r: r.slot)
    share = {p: sum(r.place == p for r in slots) / len(slots) for p in range(3)}
    for at in range(0, len(slots) - 64, 64):
        for p in range(3):
            assert abs(sum(r.place == p for r in slots[at:at + 64]) - 64 * share[p]) < 8
    assert len({(r.place, r.epoch, r.block) for r in slots}) == len(slots)


def test_small_sources_beside_a_huge_one(spark, monkeypatch):
    """Every source comes near its target, whatever the length of the blocks of the others."""
    monkeypatch.setattr(mixing, "SLOTS", 1 << 9)
    monkeypatch.setattr(mixing, "LEAST_SLOTS", 64)
    rows = [(i, "w " * 3000, "huge") for i in range(400)] + [(1000 + i, "w " * (i % 7 + 1), f"s{i % 60:02}") for i in range(900)]
    got = mixed(spark, rows)["documents"].collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert len(target) == 61 and all(abs(taken[s] - t) <= max(1, 0.03 * t) for s, t in target.items()), (taken, target)


def test_odd_mixes(spark):
    rows = [(1, None, "a"), (None, "", "a"), (None, "", "a"), (2, "\x0b \t", None)]
    assert [r.taken for r in mixed(spark, rows)["documents"].collect()] == [0] * 4
    assert mixed(spark, [])["documents"].collect() == []
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "x " * 60_000, "t"), (None, "q r", None)]
    check_mix(mixed(spark, rows)["documents"].collect(), rows, 1)


# ---- WARC ---------------------------------------------------------------------------------------

def test_archives_hold_what_was_written(spark):
    big = "".join(random.Random(1).choices("abcdefgh <>", k=300_000))
    rows = [(1, "http://a/é x", "<p>ä</p>", 1), (2, None, None, 2), (3, "u", "", 3), (4, "u", "<p>ä</p>", 4), (None, "u", "<p>ä</p>", 5), (5, "u", big, 6)]
    rows += [(10 + i, f"http://a/{i}", f"<html><body><p>page number {i} of some similar pages</p></body></html>", i) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, digest INT").repartition(3)
    archives = warc.write_archives(pages)
    got = {r.record_id: r for r in warc.read_archives(archives).collect()}
    assert len(got) == len(rows) and all(r.error is None for r in got.values())
    for i, _, text, _ in rows:
        r = got[f"<urn:page:{'' if i is None else i}>"]
        body = (text or "").encode()
        assert r.payload_bytes == len(body) and r.payload_digest == warc.digest_of(body)
        copy = {1: 4, None: 4, 2: 3}.get(i)
        assert (r.record_type, r.refers_to) == (("revisit", f"<urn:page:{copy}>") if copy else ("response", None))
        assert r.payload == (None if copy else body)
    assert all(r.error is None and r.record_type == "response" for r in warc.read_archives(warc.write_archives(pages, least=10**6)).collect())
    assert warc.read_archives(warc.write_archives(pages.limit(0))).collect() == []


def read(spark, tmp_path, data):
    (tmp_path / "x.warc.zst").write_bytes(data)
    archives = spark.createDataFrame([(str(tmp_path / "x.warc.zst"),)], "archive STRING")
    return sorted(warc.read_archives(archives).collect(), key=lambda r: r.offset)


def frame(record, known=None):
    return zstandard.ZstdCompressor(dict_data=known).compress(record)


def test_dictionaries_plain_and_compressed(spark, tmp_path):
    records = [warc._record(i, "u", b"<p>words and more words %d</p>" % i, 30, warc.digest_of(b""), None) for i in range(200)]
    records = [warc._record(i, "u", (p := b"<p>words and more words %d</p>" % i), len(p), warc.digest_of(p), None) for i in range(200)]
    known = zstandard.train_dictionary(4096, records)
    for body in (known.as_bytes(), zstandard.compress(known.as_bytes())):
        lead = struct.pack("<II", warc.DICTIONARY_MAGIC, len(body)) + body
        other = struct.pack("<II", 0x184D2A50, 3) + b"xyz"
        got = read(spark, tmp_path, lead + frame(records[0], known) + other + frame(records[1], known))
        assert [r.error for r in got] == [None, None] and got[1].payload == b"<p>words and more words 1</p>"
    assert "frame" in read(spark, tmp_path, frame(records[0], known))[0].error  # the dictionary is missing


def test_damage_is_reported(spark, tmp_path):
    good = warc._record(1, "u", b"body", 4, warc.digest_of(b"body"), None)
    cases = {
        "version": good.replace(b"WARC/1.1", b"WARC/9.9"), "no warc-date": good.replace(b"WARC-Date: 2000-01-01T00:00:00Z\r\n", b""),
        "bad warc-date": good.replace(b"2000-01-01T00:00:00Z", b"yesterday"), "header line": good.replace(b"WARC-Type: ", b"WARC Type "),
        "longer": good + b"x", "shorter": good[:-8], "block digest": good.replace(b"body", b"bodi"),
        "payload digest": re.sub(rb"WARC-Block-Digest: .*?\r\n", b"", good).replace(b"body", b"bodi"),
        "no end of headers": b"WARC/1.1\r\n", "twice": good.replace(b"WARC-Date", b"Content-Length: 4\r\nWARC-Date"),
        "bad content-length": re.sub(rb"(type=response\r\nContent-Length: )\d+", rb"\1-4", good),
        "payload length": re.sub(rb"WARC-(Block|Payload)-Digest: .*?\r\n", b"", good).replace(b"utf-8\r\nContent-Length: 4", b"utf-8\r\nContent-Length: 9"),
    }
    got = read(spark, tmp_path, frame(good) + b"".join(map(frame, cases.values())) + frame(good)[:-9])
    assert len(got) == len(cases) + 2 and got[0].error is None and got[0].payload == b"body"
    for name, r in zip(cases, got[1:]):
        assert r.error and name.replace("version", "version line") in r.error, (name, r.error)
    assert got[-1].error == "truncated frame"
    assert read(spark, tmp_path, b"") == [] and read(spark, tmp_path, b"junk that is no archive")[0].error


def test_lengths_of_thousands_of_digits(spark, tmp_path):
    good = warc._record(1, "u", b"body", 4, warc.digest_of(b"body"), None)
    outer, inner = rb"(type=response\r\nContent-Length: )\d+", rb"(utf-8\r\nContent-Length: )4"
    plain = re.sub(rb"WARC-(Block|Payload)-Digest: .*?\r\n", b"", good)
    size = re.search(outer.replace(rb"\d+", rb"(\d+)"), good)[2]
    cases = [re.sub(outer, rb"\g<1>" + b"9" * 5000, good), re.sub(outer, rb"\g<1>" + b"0" * 5000 + size, good), re.sub(inner, rb"\g<1>" + b"7" * 5000, plain)]
    errors = [r.error for r in read(spark, tmp_path, b"".join(map(frame, cases)))]
    assert "bad content-length" in errors[0] and errors[1] is None and errors[2]
