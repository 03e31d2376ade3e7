"""Pages, benchmark items, shards, and the pipeline against a brute-force version of it."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from gitsift.llm import decontam, page_text, sharding

ITEMS = ["the quick brown fox jumps over the lazy dog while seven wizards mix a box of quartz",
         "numbers one two three four five six seven eight nine ten eleven twelve thirteen", "tiny"]


# --- benchmark items --------------------------------------------------------
def semi_global(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at, letter = rng.randrange(len(out)), rng.choice("qzx ")
        kind = rng.random()
        if kind < 0.4:
            out[at] = letter
        elif kind < 0.7:
            out.insert(at, letter)
        else:
            del out[at]
    return " ".join("".join(out).split())


def plain_search(items, texts):
    """Fewest edits and number of passages found per (text, item), by comparing all with all."""
    found = {}
    for k, text in enumerate(texts):
        for number, item in enumerate(items):
            parts = [item[a:b] for a, b in decontam.passages(item)]
            edits = [(semi_global(p, text), decontam.edit_budget(len(p))) for p in parts if p]
            good = [e for e, most in edits if e <= most]
            if good:
                found[k, number] = (min(good), len(good))
    return found


def compared(items, texts):
    found = decontam.Items(list(range(len(items))), items).search(texts)
    want = plain_search(items, texts)
    assert {(a, b): (edits, n) for a, b, _, _, edits, n in found} == want
    for text, item, start, end, edits, _ in found:
        region = texts[text][start:end]
        assert any(semi_global(items[item][a:b], region) == edits for a, b in decontam.passages(items[item]))
    return want


def test_searches_equal_brute_force(monkeypatch):
    rng = random.Random(7)
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"
    phrase = "which of the following is true"
    items = [*ITEMS, ITEMS[0][:12], ITEMS[1][:15], ITEMS[1][20:37], "ab", "", ITEMS[0], "aaaaaaaaaaaaaaaaaaaaaaaa",
             *(f"{phrase} of {w}" for w in ("red birds", "blue stars in the night", "gold")),
             " ".join(ITEMS[:2]) + " and " + " ".join(reversed(ITEMS[1].split()))]
    seen = set()
    for trial in range(60):
        texts = ["", filler, "a" * rng.randint(20, 300)]
        for _ in range(3):
            item = rng.choice(items)
            at = rng.randrange(max(1, len(item) // 2))
            part = item[at:at + rng.randint(len(item) // 3, len(item))] if rng.random() < 0.4 else item
            part = edited(part, rng.randint(0, len(part) * 15 // 100), rng) if part else part
            texts.append(rng.choice([part, f"{filler} {part} {filler}", f"{part}{filler}", f"{filler}{part}"]))
        # Few hits and bands at a time: the parts must give what the whole gives.
        monkeypatch.setattr(decontam, "HITS_AT_ONCE", rng.choice([1, 50, 1 << 22]))
        monkeypatch.setattr(decontam, "BANDS_AT_ONCE", rng.choice([1, 7, 1 << 12]))
        seen |= set(compared(items, texts).values())
    assert len({e for e, _ in seen}) >= 6 and len({n for _, n in seen}) >= 4


@pytest.mark.parametrize("size", [12, 13, 17, 18, 19, 40, 64, 150])
def test_every_length_has_its_budget(size):
    rng = random.Random(size)
    item = "".join(rng.choice("abcdefghijklmnop") for _ in range(size))
    budget = decontam.edit_budget(min(size, decontam.PASSAGE))
    assert budget == {12: 1, 13: 1, 17: 1, 18: 2, 19: 2, 40: 4}.get(size, 7)
    for _ in range(20):
        text = list(item)
        for at in rng.sample(range(size), budget):
            text[at] = "#"
        assert (0, 0) in compared([item], [f"some words {''.join(text)} more words"])


def test_halves_of_long_items_are_found():
    rng = random.Random(3)
    item = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(22))[:150]
    for half in (item[:75], item[75:]):
        assert compared([item], [f"before {half} behind"]) != {}
    assert compared([item], [f"before {item[:40]} behind"]) == {}


def test_phrases_of_many_items_are_no_leaks():
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 8))) for _ in range(n))

    phrase = "which of the following is true"
    items = [f"{words(3)} {phrase} {words(3)}" for _ in range(1000)]
    texts = [f"{words(40)} {phrase} {words(40)}" for _ in range(20)]
    found = decontam.Items(list(range(1000)), items).search([*texts, f"x {items[7]} y"])
    assert (20, 7) in {(f[0], f[1]) for f in found} and {f[0] for f in found} == {20}


def test_leaks_of_rows_and_shards(spark):
    docs = [(1, f"Before.  {ITEMS[0].upper()}\n after", "a"), (1, f"Before.  {ITEMS[0].upper()}\n after", "a"),
            (2, "nothing here", "b"), (3, None, "c"), (4, "", "d"), (None, ITEMS[1], None),
            (5, "x " * 30000 + ITEMS[1] + " y" * 30000, "e"), (6, "so tiny a thing", "f")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*enumerate(ITEMS), (3, None), (4, ""), (5, ITEMS[0]), (None, "absent from all")],
                                  "item_id long, text string")
    want = sorted([(1, 0), (1, 0), (1, 5), (1, 5), (None, 1), (5, 1), (6, 2)], key=str)
    found = decontam.find(df, bench)
    assert sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str) == want
    several = decontam.shards(bench, shard_chars=60)
    assert len(several) > 1 and sorted(len(s.ids) for s in several) and sum(len(s.ids) for s in several) == 5
    kept = decontam.keep_clean(df, bench)
    assert kept.schema == df.schema and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontam.find(df.limit(0), bench).count() == decontam.find(df, bench.limit(0)).count() == 0


# --- pages ------------------------------------------------------------------
PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><p>Site name of some words</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies a lot on this page</p></div>
<%s><h1>The &amp; title</h1><p>First   <b>para</b>graph&nbsp;of text<br>goes on here
<p>Second one is not closed <div class="ad"><p>Buy this and that now</p></div>
<form><input><label>Your mail</label></form><p>Third &lt;kept&gt;</p></%s>
<section id="comments"><p>A reader says that it is nice</p></section>
<aside><p>Other pages that you may like</p></aside><footer>&copy; somebody</footer></body></html>"""
TEXT = "The & title\nFirst paragraph of text goes on here\nSecond one is not closed\nThird <kept>"


def test_pages_with_and_without_markers(spark):
    rows = [(k, "u", PAGE % ("article", "article")) for k in range(5)]
    rows += [(5, None, PAGE % ("div", "div")), (6, "u", None), (7, "u", ""), (8, "u", "<p>cut <b>sho"),
             (None, "u", PAGE % ("main", "main")), (9, "u", "<" * 50 + "no tags & all"), (0, "u", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS text", "2 AS n_chars")
    found = page_text.extract(df).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    by_id = defaultdict(set)
    for r in found:
        by_id[r.page_id].add(r.text)
    assert all(by_id[k] == {TEXT} for k in (0, 1, 2, 3, 4, 5, None))
    assert by_id[6] == by_id[7] == {""} and by_id[8] == {"cut sho"}
    assert page_text.extract(df.limit(0)).count() == 0


def test_registered_pages_equal_a_plain_reading(spark, sf_dir):
    from gitsift.llm.queries import QUERIES

    want = {}
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", inner))
        want[row.page_id] = "\n".join(b for b in blocks if b)
    found = QUERIES["op6_html_extraction"](spark, sf_dir).collect()
    assert {r.page_id: r.text for r in found} == want


# --- shards -----------------------------------------------------------------
def test_flows_move_the_fewest_bytes():
    rng = random.Random(1)
    for _ in range(200):
        sizes, new = [rng.randint(0, 40) for _ in range(rng.randint(1, 5))], rng.randint(1, 5)
        flow = sharding.transfers(sizes, new)
        total = sum(sizes)
        capacity = [total // new + (j < total % new) for j in range(new)]
        assert [sum(row) for row in flow] == sizes
        assert [sum(row[j] for row in flow) for j in range(new)] == capacity
        stay = sum(flow[k][k] for k in range(min(len(sizes), new)))
        assert stay == sum(min(a, b) for a, b in zip(sizes, capacity))


def test_shards_of_awkward_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, "x" * rng.randint(0, 300), f"s{min(k % 7, 3)}") for k in range(600)]
    rows += [(5, rows[5][1], "s0"), (None, None, None), (None, "a", "s1"), (900, None, "s1"), (901, "é" * 2000, "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS block")
    by_source = sharding.F.pmod(sharding.F.xxhash64("source"), sharding.F.lit(8))
    found = sharding.reshard(df, by_source, 8, 8).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    held, slots = Counter(), defaultdict(list)
    for r in found:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(held.values()) - min(held.values()) <= 2 * 4001  # twice the longest row
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.reshard(df.limit(0), by_source, 8, 8).count() == 0


def test_rewriting_touches_affected_shards_only(spark, tmp_path):
    rows = [(k, "x" * 50, k % 3) for k in range(90)] + [(k, "y" * 50, 0) for k in range(90, 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old int")
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    docs.withColumnRenamed("old", "shard").write.partitionBy("shard").parquet(old)
    assigned = sharding.reshard(docs, docs["old"], 3, 3)
    places = sharding.rewrite(docs.drop("old"), assigned, old, new)
    shard_of = {r.doc_id: r.shard for r in assigned.collect()}
    for shard, path in places.items():
        assert {r.doc_id for r in spark.read.parquet(path).collect()} == {d for d, s in shard_of.items() if s == shard}
    with pytest.raises(ValueError):
        sharding.rewrite(docs.withColumnRenamed("old", "slot"), assigned, old, new)


def test_moving_takes_whole_rows_to_their_shards(spark, tmp_path):
    """Every row lies where it is said to go, with all its columns; the query reads what was moved."""
    rows = [(k if k % 9 else None, "é" * (k % 40) if k % 11 else None, f"s{min(k % 5, 2)}") for k in range(300)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by_source = sharding.F.pmod(sharding.F.xxhash64("source"), sharding.F.lit(8))
    moved = sharding.move(df, by_source, 8, 3, str(tmp_path / "new"))
    found = moved.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows)
    digests = Counter((r.doc_id, zlib.crc32((r.text or "").encode()), r.old_shard, r.shard, r.slot) for r in found)
    assert digests == Counter((r.doc_id, r.text_crc32, r.old_shard, r.shard, r.slot)
                              for r in sharding.reshard(df, by_source, 8, 3).collect())
    for shard in range(3):
        lying = spark.read.parquet(str(tmp_path / "new" / f"shard={shard}"))
        assert Counter((r.doc_id, r.text, r.source) for r in lying.collect()) == Counter(
            (r.doc_id, r.text, r.source) for r in found if r.shard == shard)
    with pytest.raises(ValueError):
        sharding.move(df.withColumn("slot", sharding.F.lit(1)), by_source, 8, 3, str(tmp_path / "other"))


def test_the_query_on_shards_reads_them_where_they_were_moved_to(spark, sf_dir):
    from urllib.parse import urlparse

    from gitsift.llm.queries import QUERIES

    found = QUERIES["op10_min_cost_resharding"](spark, sf_dir)
    folders = {Path(urlparse(f).path).parent for f in found.inputFiles()}
    assert {f.name for f in folders} == {f"shard={k}" for k in range(8)}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    moved = spark.read.parquet(*{str(f.parent) for f in folders}).select("doc_id", "text", "source")
    assert Counter(map(tuple, moved.collect())) == Counter(map(tuple, texts.collect()))


# --- the pipeline -----------------------------------------------------------
def test_pipeline_equals_its_brute_force_version(spark, sf_dir, monkeypatch):
    from test_duplicates import brute_lines, classes_of
    from test_tokens_quality_language import PATH, brute_quality

    import corpus_pipeline
    from gitsift.llm import bpe, quality, simhash

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    def passes(text):
        words = text.encode().split()
        if len(words) < 50:
            return False
        # The quadratic brute force is for short texts; their statistics are equal elsewhere.
        found = brute_quality(text) if len(words) < 120 else quality.document_statistics([text.encode()])[0].tolist()
        n, repeated, longest, spans = found[0], found[4], found[5], found[6]
        return 100 * repeated <= 50 * n and spans <= 0.3 * n and longest <= max(60, 0.2 * n)

    kept = {d: t for d, t in docs.items() if passes(t)}
    kept = {d: t for d, _, _, t in brute_lines(list(kept.items()))}
    order = sorted(kept)
    prints = [simhash.fingerprint(kept[d].encode(), 5) for d in order]
    kept = {d: kept[d] for d, root in zip(order, classes_of(prints, 5)) if d == order[root]}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if not any(i in " ".join(t.lower().split()) for i in items)}
    with open(PATH, "rb") as handle:
        codec = bpe.Codec(handle.read(), corpus_pipeline.public_tokenizers.PATTERN)
    want = {d: (len(codec.encode(t)), hashlib.sha256(codec.pack(t)).hexdigest(),
                hashlib.sha256(t.encode()).hexdigest()) for d, t in kept.items()}
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == want
    assert len(found) == len(want) and [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules"


def test_stages_keep_the_columns_and_bear_awkward_rows(spark, sf_dir):
    import corpus_pipeline

    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, text, None, None, None), (2, None, "en", "s", 0),
            (3, "", None, "s", 0), (4, text + " end", "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0)):
        out = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, sf_dir)
            assert out.columns == docs.columns, name
        final = corpus_pipeline.STAGES[-1][1](spark, out, sf_dir)
        ids = sorted((r.doc_id for r in final.collect()), key=str)
        # Document 4 is a near copy of 1; a row without doc_id is never a copy.
        assert ids == ([1, None] if df is docs else [])
