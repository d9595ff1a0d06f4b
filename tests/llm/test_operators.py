"""Corpus operators against plain versions, laws and round trips, on small tables with every awkward kind of row."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from conftest import SF_DIR  # noqa: E402

import __spark_entry__  # noqa: E402, F401
from fleet_engine.llm import decontaminate, jaccard, licenses, line_dedup, linear, packing, quality_rules, sharding, suffixes, toxicity, warc  # noqa: E402
from fleet_engine.llm.sql import LICENSES_SQL  # noqa: E402
from fleet_engine.workspace import run_dir  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, _key string, n_lines string, score string"


def make_docs(spark, rows):
    """Documents with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, None, None, None, None, "x", "y", "z") for i, t in rows], DOCS)


def awkward_rows():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(2, 7)))
    passages = [" ".join(word() for _ in range(80)) for _ in range(6)]
    shared = "  This line stands in very many documents of the corpus  "
    rows = []
    for i in range(40):
        parts = [rnd.choice(passages)[rnd.randint(0, 200):][:rnd.randint(150, 400)] if rnd.random() < .6 else " ".join(word() for _ in range(40))
                 for _ in range(rnd.randint(0, 4))]
        rows.append((i, "\n".join(parts + [shared.upper() if i % 3 else shared] * (i % 2))))
    base = " ".join(word() for _ in range(120))
    rows += [(50 + k, base.replace(base.split()[10 * k], "changed", 1)) for k in range(6)]
    return rows + [(100, None), (101, ""), (102, "x" * 1000), (103, "x" * 150), (104, "ab" * 500), (105, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]),
                   (None, None), (106, "é" * 300), (107, " \n\t\n "), (108, " ".join(word() for _ in range(30_000))), (3, rows[3][1])]


@pytest.fixture(scope="module")
def awkward(spark):
    return make_docs(spark, awkward_rows()).repartition(5)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def as_lists(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(tuple(r[1:]))
    return {k: sorted(v, key=repr) for k, v in out.items()}


# ---- line dedup

def test_line_dedup(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    where = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            where[key(line)].add(i)
    bad = {k: max(x for x in v if x is not None) for k, v in where.items() if len(k) >= 40 and len(v) >= 5}
    assert bad
    want = defaultdict(list)
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if key(line) not in bad or bad[key(line)] == i]
        want[i].append((len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = line_dedup.line_dedup(awkward.select("doc_id", "text"), digest_only=True)
    assert as_lists(got.collect()) == {k: sorted(v, key=repr) for k, v in want.items()}
    whole = line_dedup.line_dedup(awkward)
    assert whole.columns == [c for c in awkward.columns if c != "n_lines"] + ["n_lines", "n_dropped"] and whole.count() == len(rows)


# ---- suffixes

def plain_repeats(rows):
    seen = Counter(b[p:p + 200] for _, b in rows for p in range(len(b) - 199))
    out = defaultdict(list)
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i].append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v, key=repr) for k, v in out.items()}


@pytest.mark.parametrize("batches, hot", [(2, 16_000), (5, 3)])
def test_suffix_dedup(spark, awkward, batches, hot):
    rows = [(r.doc_id, (r.text or "").encode()) for r in awkward.select("doc_id", "text").collect()]
    got = suffixes.remove_repeats(awkward, batches=batches, hot=hot).drop("kept")
    assert as_lists(got.collect()) == plain_repeats(rows)


def test_suffix_samples_of_a_sliced_text(monkeypatch):
    text = bytes(random.Random(1).choices(b"abcd ", k=9000))
    collect = lambda: sorted(zip(*(np.concatenate(c).tolist() for c in zip(*suffixes.suffixes([text])))))
    whole = collect()
    monkeypatch.setattr(suffixes, "SLICE", 1024)
    assert collect() == whole and len(whole) > 50
    suffixes._POWERS.clear()


def test_suffix_levels_merge_geometrically(spark):
    family = suffixes.SuffixLevels(spark)
    found = [sorted(r[0] for r in family.add(spark.createDataFrame([(x,) for x in batch], "print bigint")).collect())
             for batch in ([1, 2], [2, 3], [4], [5, 5, 1], [9])]
    assert found == [[], [2], [], [1, 5], []] and [rank for rank, _ in family.levels] == [2, 0]


# ---- Jaccard join

def test_jaccard_join(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]

    def grams(t):
        w = re.split(r"[\x20\x09-\x0D]+", (t or "").lower())
        w = [x for x in w if x]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [grams(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if j != i and rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]
             and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
    first = {x: min(rows[i][0] for i in range(len(rows)) if label[i] == x) for x in set(label) if rows[x][0] is not None}
    want = Counter((rows[i][0], first.get(label[i]), len(near[i]), len({frozenset(sets[j]) for j in near[i]} - {frozenset(sets[i])})) for i in range(len(rows)))
    for block in (2048, 2):
        got = jaccard.jaccard_join(awkward, block_docs=block).select("doc_id", "class_id", "n_links", "n_text_links").collect()
        assert Counter(tuple(r) for r in got) == want
    kept = [r.doc_id for r in jaccard.keep_one(awkward).collect()]
    assert Counter(kept) == Counter(set(first.values()) - {None}) + Counter({None: 2}) and max(Counter(kept).values()) == 2


def test_keep_one_goes_by_row(spark):
    """An id with two texts loses only the one that is a near copy of a smaller id's text."""
    base, own = rows_text(1), rows_text(2)
    docs = make_docs(spark, [(1, base), (2, base + " tail"), (2, own), (2, own), (3, None), (3, ""), (None, base)]).withColumn("_row_key", F.lit(1))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter([(1, base), (2, own), (3, ""), (None, base)])


def test_lines_of_rows_without_id(spark):
    """Rows without an id are one document to the count, and each drops its own lines only."""
    line, other = "a line that stands in five documents, said twice", "another line that stands in five documents as well"
    rows = [(i, f"{line}\n{other}") for i in range(1, 5)] + [(None, f"{line}\nx {k}") for k in range(30)] + [(None, other), (None, None)]
    docs = make_docs(spark, rows)
    got = line_dedup.line_dedup(docs).collect()
    assert Counter((r.doc_id, r.text, r.n_dropped) for r in got) == Counter(
        [(i, "", 2) for i in (1, 2, 3)] + [(4, f"{line}\n{other}", 0)] + [(None, f"x {k}", 1) for k in range(30)] + [(None, "", 1), (None, None, 0)])
    few = line_dedup.shared_lines(docs, "doc_id", "text", 40, 5).filter("_id IS NULL")
    assert {len(r["_keys"]) for r in few.collect()} == {1}


def test_jaccard_join_with_empty_blocks(spark, monkeypatch):
    """Few long texts in many blocks, some of which hold no text: each link counts once."""
    rnd = random.Random(5)
    docs = []
    for group in range(12):
        words = [f"g{group}w{rnd.randint(0, 10 ** 6)}" for _ in range(400)]
        docs += [(10 * group + k, " ".join(words + [f"tail{k}"] * 2)) for k in range(3)]
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 250)
    got = jaccard.jaccard_join(make_docs(spark, docs)).collect()
    assert len(got) == 36 and {(r.class_id, r.n_links, r.n_text_links) for r in got} == {(10 * g, 2, 2) for g in range(12)}


def test_bands_reach_the_recall():
    bands, rows = jaccard.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 300


# ---- sharding

@pytest.mark.parametrize("shards", [4, 16])
def test_shards(spark, awkward, shards):
    rows = sharding.shard_documents(awkward, shards).collect()
    texts = awkward.select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (t.doc_id, len((t.text or "").encode()) + 1, zlib.crc32((t.text or "").encode())) for t in texts)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(shards)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_links_cut(spark):
    """Pairs and a path stay whole; a group of more than a shard holds is spread over as few shards as hold it, but for the last rows."""
    rows = [(i, f"text {i // 2}") for i in range(200)] + [(1000 + i, "hot") for i in range(150)]
    got = sharding.shard_documents(make_docs(spark, rows), 7).collect()
    shard = {r.doc_id: r.shard for r in got}
    assert sum(shard[i] != shard[i + 1] for i in range(0, 200, 2)) <= 6     # at most one for each edge between two shards
    counts = Counter(shard[1000 + i] for i in range(150))
    assert sum(n for _, n in counts.most_common(4)) >= 120


@pytest.mark.parametrize("size", [2, 4])
def test_full_shards_cut_a_link_per_edge(spark, size):
    """Every row is linked and every shard is full: only the edge between two shards cuts a link."""
    got = sharding.shard_documents(make_docs(spark, [(i, f"text {i // size}") for i in range(2000)]), 16).collect()
    places = defaultdict(set)
    for r in got:
        places[r.doc_id // size].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 15
    assert sorted(Counter(r.shard for r in got).values()) == [125] * 16
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(125)) for s in range(16))


def test_rows_alike_are_split(spark):
    """Rows without id and text are alike in all columns and still fall into several ranges."""
    rows = make_docs(spark, [(None, None)] * 500 + [(1, "a"), (2, "a")])
    got = sharding.shard_rows(rows, spark.createDataFrame([(1, "a"), (2, "a")], "id bigint, link string"), 7, "doc_id", F.lit(""), range_rows=20).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [71] * 2 + [72] * 5
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in range(7))
    assert len({r.shard for r in got if r.doc_id is not None}) == 1


# ---- packing

def test_packing(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = awkward.select("doc_id", "text").collect() + [("special", "a <|endoftext|> b")]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(999, "a <|endoftext|> b")], "doc_id bigint, text string"))
    got = packing.pack(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = Counter()
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            piece = ids[start:first if k == 0 else start + 1024]
            want[(999 if i == "special" else i, k, start, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 1024
    assert len(by) <= -(-sum(r.length for r in got) // 1024) + 2


def test_placing_follows_the_rule():
    lengths = np.random.default_rng(2).integers(1, 65, 300)
    where, offset = packing.place(lengths, 64)
    fill, order = {}, np.argsort(-lengths, kind="stable")
    for i in order:
        gaps = Counter(64 - f for f in fill.values() if f < 64)
        change = {}
        for g in (g for g in gaps if g >= lengths[i]):
            after = gaps.copy()
            after[g] -= 1
            if g > lengths[i]:
                after[g - lengths[i]] += 1
            change[g] = sum(n * n for n in after.values())
        assert offset[i] == fill.get(where[i], 0)
        if change:
            gap = 64 - fill[where[i]]
            assert change[gap] == min(change.values()) and gap == min(g for g in change if change[g] == change[gap])
        else:
            assert where[i] not in fill
        fill[where[i]] = fill.get(where[i], 0) + lengths[i]


def test_pieces():
    assert packing.cuts(1) == [(0, 1)] and packing.cuts(1024) == [(0, 1024)] and packing.cuts(2050) == [(0, 2), (2, 1024), (1026, 1024)]


# ---- WARC

def test_warc(spark):
    big = "é" * 600
    rows = [(1, "u1", big), (5, "u\r\n5", big), (3, None, big), (2, "u2", "small"), (4, "u4", "small"), (6, "u6", None), (None, "u0", big), (5, "u\r\n5", big), (7, "", "")]
    archive = warc.write_archive(spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string"), run_dir(spark, "warc"))
    got = warc.read_records(spark, archive).collect()
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    kind = lambda i, t: ("revisit", 5) if t == big and i != 5 else ("response", None)
    assert Counter(tuple(r) for r in got) == Counter((i, len((t or "").encode()), sha(t), *kind(i, t), True) for i, _, t in rows)
    assert spark.read.parquet(archive.payloads).count() == len({t or "" for _, _, t in rows})
    assert Counter((r.page_id, bytes(r.payload)) for r in warc.read_pages(spark, archive).collect()) == Counter((i, (t or "").encode()) for i, _, t in rows)
    for r in warc.rebuild_records(spark, archive).collect():
        head, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and len(rest) == int(fields[b"Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        if fields[b"WARC-Type"] == b"response":
            assert fields[b"WARC-Payload-Digest"] == b"sha1:" + hashlib.sha1(rest[:-4]).hexdigest().encode()


def test_damaged_payload_is_noticed(spark):
    path = run_dir(spark, "warc-damaged")
    spark.createDataFrame([("00", bytearray(b"x"))], "digest string, payload binary").write.parquet(path)
    with pytest.raises(Exception, match="does not match its digest"):
        warc.verified_payloads(spark, warc.Archive("", path)).collect()


# ---- licenses

def test_licenses(spark):
    texts = ["Licensed under CC BY-NC 4.0. cc by, CC-BY", "SPDX-License-Identifier: Apache-2.0", "This is under the MIT License.", None, "", "CC BY", "ACC BY cc bye",
             "the GNU General Public License, version 3. All rights reserved.", "see the Apache License, Version 2.0 here", "nothing to see " * 30_000]
    got = {r.doc_id: r for r in licenses.license_scan(make_docs(spark, list(enumerate(texts)))).collect()}
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (3, 2, 9, "cc-by") and "cc-by-nc-4.0" in got[0].labels.split(",")
    assert (got[1].labels, got[1].score) == ("apache-2.0", 1.0) and got[2].labels == "mit"
    assert all((got[i].n_words, got[i].labels, got[i].first_word, got[i].score) == (0, "", None, 0.0) for i in (3, 4))
    assert got[5].n_words == 1 and got[5].n_base == 0 and got[6].n_base == 0
    assert got[7].base_labels == "gpl,reserved" and got[7].labels == "gpl,gpl-3.0,reserved"
    assert got[8].labels == "apache-2.0"      # the loose name inside the title is suppressed
    assert got[9].n_words == 90_000 and got[9].labels == ""


def test_every_rule_has_a_gate():
    found = licenses.rules()
    assert len(found) > 300 and all(r.keyword and any(g in r.keyword for g in licenses.GATES) for r in found)
    assert all(re.compile(r.pattern) for r in found)


def expansions(tree):
    """Texts that a parsed pattern accepts, with every branch taken somewhere; repeats stand zero times and once."""
    from itertools import product

    parts = []
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(value)])
        elif name == "NOT_LITERAL":
            parts.append(["z"])
        elif name == "IN":
            kinds = [str(k) for k, _ in value]
            parts.append(["z"] if kinds[0] == "NEGATE" else [chr(v if k == "LITERAL" else v[0]) for k, v in zip(kinds, (v for _, v in value))])
        elif name == "BRANCH":
            parts.append([t for branch in value[1] for t in expansions(branch)])
        elif name == "SUBPATTERN":
            parts.append(expansions(value[-1]))
        elif name == "MAX_REPEAT":
            low, _, inner = value
            parts.append(sorted({t * n for n in (low, max(low, 1)) for t in expansions(inner)}))
        else:
            raise ValueError(name)
    return ["".join(p) for p in product(*parts)]


def test_every_match_holds_a_needle():
    from re import _parser

    found = licenses.rules()
    own = [r for r in found if r.tier != licenses.GRANT]      # a grant is a title behind fixed words, with the title's keyword
    assert {(r.label, r.keyword, r.pattern) for r in found if r.tier == licenses.GRANT} == {(r.label, r.keyword, licenses.GRANTS + r.pattern) for r in found if r.tier == licenses.TITLE}
    for r in own:
        texts = expansions(_parser.parse(r.pattern))
        assert texts and all(re.fullmatch(r.pattern, t) for t in texts)
        assert all(any(n in t for n in r.needles) for t in texts), r
    assert all(any(g in n for g in licenses.GATES) for r in found for n in r.needles)
    assert set(licenses.NEEDLES) <= {(r.keyword, r.pattern) for r in found}


def test_licenses_behind_other_words(spark):
    texts = {"https://opensource.org/license/mit": "mit", "opensource.org/license/bsd-2-clause": "bsd-2-clause", "opensource.org/license/bsd-3-clause": "bsd-3-clause",
             "opensource.org/license/isc": "isc", "https://www.gnu.org/copyleft/gpl.html": "gpl", "All rights are reserved": "reserved",
             "may not be reproduced without the prior written permission": "proprietary", "Commercial use is strictly prohibited": "non-commercial",
             "under a BSD-style license": "bsd", "under a MIT-style license": "mit", "see LICENSE.txt": "see-license", "see the license.md": "see-license"}
    got = {r.doc_id: r for r in licenses.license_scan(make_docs(spark, list(enumerate(texts)))).collect()}
    for i, label in enumerate(texts.values()):
        assert label in got[i].labels.split(",") and got[i].score > 0, (i, got[i])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t in enumerate(texts)])
    cursor = con.execute(LICENSES_SQL)
    columns = [c[0] for c in cursor.description]
    assert sorted(cursor.fetchall()) == sorted(tuple(r[c] for c in columns) for r in got.values())


# ---- decontamination

def test_templates(spark):
    item = "a train with 120 passengers leaves for Rome at 9 km from the coast and then 120 more people join it before night falls over the hills"
    items = spark.createDataFrame([(1, item, 0), (2, "too short here", 0), (3, None, 0), (4, item, 0), (None, item, 0)], "item_id bigint, text string, n_windows int")
    docs = make_docs(spark, [(1, f"filler words before. {item} and after"), (2, item.replace("120", "45").replace("Rome", "Oslo")),
                             (3, item.replace("120", "45", 1).replace("120", "77")), (4, item.upper()), (5, "clean words " * 200), (6, None), (7, ""),
                             (None, item), (8, " ".join(item.split()[:9])), (9, item), (9, item), (10, item.replace("passengers", "guests"))])
    got = decontaminate.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, 1) for i in (1, 2, 4, 9, 10)}      # 3 gives one value two meanings
    assert len(got) == 5
    left = decontaminate.decontaminate(docs, items)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([3, 5, 6, 7, 8, None], key=repr) and left.columns == docs.columns
    assert decontaminate.leaks(docs, items, broadcast_windows=0).count() == 5


def test_leaks_of_whole_items(spark, small):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    texts, rows = small.collect(), items.collect()
    want = {(d.doc_id, i.item_id) for d in texts for i in rows if i.text in d.text}
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(small, items).collect()} == want and want


def test_leaks_at_every_offset(spark):
    """Short items, one changed word and any place in the document: whatever holds half of the windows is found."""
    five, fourteen = "seven grey herons crossed slowly", "the old ferry from the island carries mail and fresh bread every second winter morning"
    texts = {1: five, 2: five + " eastward", 3: "her quiet uncle repairs broken clocks daily", 4: fourteen, 5: "never mind that", 6: "12 + 7 = 19", 7: "Is 5 6 7 8 9 10 odd", 8: "!!"}
    items = spark.createDataFrame(list(texts.items()), "item_id bigint, text string")
    rows, want = [], set()
    for i in (1, 2, 3, 4, 5, 6, 7):
        for k in range(8):
            rows.append((100 * i + k, "word " * k + texts[i].replace("fresh", "stale") + " and more"))
            want.add((100 * i + k, i))
    want |= {(200 + k, 1) for k in range(8)} | {(100 + k, 2) for k in range(8)}     # the one begins the other
    rows += [(1, "12 + 8 = 20"), (2, "never mind this"), (3, "is 5 6 1 2 9 10 odd")]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(spark, rows), items).collect()}
    assert found == want


def test_leaks_of_one_template(spark):
    """Items of one template that differ in which slots are equal: each of them counts."""
    item = "the baker sells {} dark loaves before noon and then his patient neighbour buys {} white rolls for supper"
    items = spark.createDataFrame([(1, item.format(3, 3)), (2, item.format(3, 5)), (3, "a mason lays {0} flat stones along this wall and {0} more behind it".format(8))],
                                  "item_id bigint, text string")
    docs = make_docs(spark, [(1, item.format(3, 3)), (2, item.format(3, 5)), (3, item.format(4, 4)), (4, "a mason lays 8 flat stones along this wall and 9 more behind it")])
    for limit in (1_000_000, 0):
        found = decontaminate.leaks(docs, items, broadcast_windows=limit).collect()
        assert sorted((r.doc_id, r.item_id, r.n_conflicts) for r in found) == [(1, 1, 0), (2, 1, 0), (3, 1, 0)]


def test_leaks_of_lists(spark):
    """Items that repeat a window with other values at a short distance: copies are found at any place, and values must still agree."""
    shop = "in this shop the price of item is {} the price of item is {} and nothing else"
    long = "on shelf number {} stand nine old jars of dark honey " * 3
    texts = {1: shop.format(5, 7), 2: long.format(4, 6, 8), 3: "he counts stones in the box {0} then stones in the box {0} again".format(2)}
    items = spark.createDataFrame(list(texts.items()), "item_id bigint, text string")
    rows = [(100 * i + k, "word " * k + t) for i, t in texts.items() for k in range(17)]
    want = {(100 * i + k, i) for i in texts for k in range(17)}
    rows += [(1, texts[3].replace("2", "3", 1)), (2, texts[3].replace("2", "9")), (3, f"{texts[3].replace('2', '3', 1)} {texts[3].replace('2', '9')}")]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(spark, rows), items).collect()}
    assert found == want | {(2, 3), (3, 3)}


def test_leaks_with_names_at_sentence_starts(spark):
    item = "Maria runs 3 miles. Maria then walks 4 miles. Maria rests and runs 5 miles. How far did she go?"
    other = item.replace("Maria", "Ingrid").replace("3", "8")
    walk = "{} quickly walked down the steep hill. {} then bought fresh bread near the harbour."
    docs = make_docs(spark, [(1, item), (2, other), (3, "Some words before. " + other), (4, "they say that " + other), (5, item.lower()),
                             (6, "Nothing here. Maria walks home and reads."), (7, walk.format("Ingrid", "Ingrid")), (8, walk.format("Paula", "Wanda"))])
    items = spark.createDataFrame([(1, item), (2, walk.format("Maria", "Maria"))], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == {(i, 1) for i in (1, 2, 3, 4, 5)} | {(7, 2)}


# ---- classifiers

def test_plain_counts(awkward):
    for text in [r.text for r in awkward.collect()] + ["a b c a b c", "x x x x", "a\n\na\n b\na", "#*$% | &<>", "a b a b a"]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        n = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
        lines = (text or "").split("\n")
        dup = sum(1 for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:i])
        assert quality_rules.counts(text) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated))


def test_scores_of_held_out_rows():
    """Trained on one part of the labelled rows, judged on the other. Only 330 toxic rows in four languages are there to learn from."""
    import duckdb

    sql = "SELECT d.doc_id, text, quality, toxic FROM read_parquet('/root/testdata/sf0.1/documents.parquet') d JOIN read_parquet('/root/testdata/sf0.1/labels.parquet') l USING (doc_id)"
    rows = duckdb.sql(sql).fetchall()
    train, test = [r for r in rows if r[0] % 4], [r for r in rows if r[0] % 4 == 0]

    def fit(module, label):
        owner, bucket, value = module._features([r[1] for r in train])
        return module._fit((owner, bucket, value), np.array([r[label] for r in train], float), np.array([str(r[0]) for r in train]))

    import pickle
    weights, bias = pickle.loads(fit(toxicity, 3))
    owner, bucket = toxicity.grams([r[1] for r in test], weights != 0)
    score = linear.sigmoid(np.bincount(owner, weights[bucket], len(test)) + bias)
    toxic = np.array([r[3] for r in test]) == 1
    assert (score[toxic] >= 0.7).mean() > 0.6 and (score[~toxic] < 0.7).mean() > 0.99
    weights, bias, slope, shift = pickle.loads(fit(quality_rules, 2))
    good = np.array([r[2] for r in test]) == 1
    p = linear.sigmoid(slope * (quality_rules.margins([r[1] for r in test], weights) + bias) + shift)
    assert (p[good] >= quality_rules.KEEP_FROM).mean() > 0.99 and (p[~good] < quality_rules.KEEP_FROM).mean() > 0.95


def test_scores_without_labels(spark, awkward):
    none = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    one = spark.createDataFrame([(1, 0, 1), (None, 1, 0), (2, None, None)], "doc_id bigint, toxic int, quality int")
    for labels in (none, one):
        scores = toxicity.score_toxicity(awkward.select("doc_id", "text"), toxicity.train_toxicity(awkward, labels)).collect()
        assert len(scores) == len(awkward_rows()) and all(r.score < 0.01 for r in scores)
        kept = quality_rules.quality_rules(awkward.select("doc_id", "text"), quality_rules.train_quality(awkward, labels)).collect()
        assert all(r.kept == (not r.base_failed) for r in kept) and any(r.kept for r in kept)


def test_empty_tables(spark):
    docs, labels = make_docs(spark, []), spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert sharding.shard_documents(docs).count() == 0 and licenses.license_scan(docs).count() == 0
    assert toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).count() == 0
    assert quality_rules.quality_rules(docs, quality_rules.train_quality(docs, labels)).count() == 0
    assert packing.pack(docs, RANKS, public_tokenizers.PATTERN).count() == 0 and jaccard.jaccard_join(docs).count() == 0
    assert line_dedup.line_dedup(docs).count() == 0 and suffixes.remove_repeats(docs).count() == 0 and decontaminate.leaks(docs, items).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_records(spark, warc.write_archive(pages, run_dir(spark, "warc"))).count() == 0


def test_columns_named_like_inner_ones(spark):
    """Extra columns with the names that stages use for their own keys."""
    line = "This line stands in very many documents of the corpus, as it is"
    rows = [(i, f"{line}\nown text number {i} with several further words in it {i * 7}", *("x",) * 5) for i in range(6)] + [(9, "what is the smallest prime above twenty of them", *("x",) * 5), (10, rows_text(3), *("x",) * 5), (11, rows_text(3), *("x",) * 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id string, _drop_id string, _leak_id string, _ID_ string, class_id string")
    items = spark.createDataFrame([(1, "what is the smallest prime above twenty of them")], "item_id bigint, text string")
    out = line_dedup.line_dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"] and {r.doc_id: r.n_dropped for r in out.collect()}[0] == 1
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 3, 4, 5, 10, 11]
    one = jaccard.keep_one(docs)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == [0, 1, 2, 3, 4, 5, 9, 10]


def rows_text(seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(60))
