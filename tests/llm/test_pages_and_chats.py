"""WARC archives and quotation linking."""

import base64
import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clinlake.llm import quotation, warc

SMALL = "/root/testdata/sf0.001"
PAGES = [(1, "u", "<a>é"), (2, None, "<a>é"), (2, "w\r\nx", "<a>é"), (2, "w\r\nx", "<a>é"), (None, "n", None), (None, "n", None), (7, "k", ""),
         (8, "d", "x\r\n\r\ny"), (None, "d", "x\r\n\r\ny"), (9, "long", "<p>" * 300_000)]


def _want(rows, min_bytes=0):
    by = collections.defaultdict(list)
    for i, u, h in rows:
        by[(h or "").encode()].append((i is not None, i or 0, u is not None, u or ""))
    out = []
    for body, group in by.items():
        group.sort()
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for k, (known, i, _, _) in enumerate(group):
            first = k == len(group) - 1 or len(body) < min_bytes
            out.append((i if known else None, len(body), sha, "response" if first else "revisit",
                        None if first or not group[-1][0] else group[-1][1]))
    return sorted(out, key=str)


def _got(archive):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive.pages().collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_odd_pages(spark, min_bytes):
    pages = spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, kind string, payload_key int")
    assert _got(warc.write_archive(pages, min_bytes=min_bytes)) == _want(PAGES, min_bytes)
    assert _got(warc.write_archive(pages.where("url = '-'"))) == []


def test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    archive = warc.write_archive(pages)
    assert _got(archive) == _want([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert archive.payloads().count() == archive.payloads().select("payload_key").distinct().count()


def test_records_are_whole(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for r in warc.write_archive(pages).records().collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        if fields[b"WARC-Type"] == b"response":
            assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(rest[:-4]).digest())


CHAT = [(1, 0, "user", "Hello there, world!\n\nSecond para."),
        (1, 1, "assistant", "On Monday X wrote:\n> Hello there,\n> world!\nMy answer.\n> Second para.\nOther."),
        (1, 2, "user", "> > Hello there, world!\n> My answer.\nFine"), (1, 3, "user", ">> Hello there world\nlast"),
        (1, 3, "user", ">> Hello there world\nlast"), (2, 0, None, None), (2, 5, "user", "> not said before\nx"), (None, 0, "user", "> x"),
        (3, None, "u", "y")]


def test_quotes(spark):
    chat = spark.createDataFrame([(*r, "x", 1, "h") for r in CHAT], "conv_id long, turn long, role string, text string, runs string, span int, hash string")
    got = collections.Counter((r.conv_id, r.turn, r.own_text, r.n_quotes, r.max_level, r.n_linked, r.parent_turn, r.depth)
                              for r in quotation.link_quotes(chat).collect())
    assert got == collections.Counter([
        (1, 0, "Hello there, world!\n\nSecond para.", 0, 0, 0, None, 0),
        (1, 1, "My answer.\n\nOther.", 2, 1, 2, 0, 1),
        (1, 2, "Fine", 2, 2, 2, 1, 2),
        (1, 3, "last", 1, 2, 1, 0, 3), (1, 3, "last", 1, 2, 1, 0, 3),
        (2, 0, "", 0, 0, 0, None, 0), (2, 5, "x", 1, 1, 0, 0, 1),
        (None, 0, "", 1, 1, 0, None, None), (3, None, "y", 0, 0, 0, None, None)])
    chats = {r.conv_id: r.chat for r in quotation.conversations(quotation.link_quotes(chat.where("conv_id = 2"))).collect()}
    assert chats == {2: "<|unknown|>\n\n<|user|>\nx"}
    assert quotation.link_quotes(chat.where("conv_id = 99")).collect() == []


def test_conversations_without_quotes_keep_their_text(spark):
    chat = spark.read.parquet(f"{SMALL}/conversations.parquet")
    linked = quotation.link_quotes(chat)
    assert linked.count() == chat.count()
    assert linked.where("n_linked > 0 or n_quotes > 0").count() == chat.where(F.col("text").contains(">")).count() == 0
    previous = {(r.conv_id, r.turn): r.parent_turn for r in linked.collect()}
    turns = collections.defaultdict(list)
    for c, t in previous:
        turns[c].append(t)
    assert all(previous[c, t] == (max([x for x in ts if x < t], default=None)) for c, ts in turns.items() for t in ts)


def test_long_conversations_are_summed_in_spans(spark):
    chat = spark.range(9000).select(F.lit(1).alias("conv_id"), (F.col("id") * 3).alias("turn"), F.lit("user").alias("role"), F.lit("t").alias("text"))
    got = {r.turn: (r.parent_turn, r.depth) for r in quotation.link_quotes(chat).collect()}
    assert all(got[3 * i] == (3 * i - 3 if i else None, i) for i in range(9000))


def test_quotes_of_any_length_and_of_single_lines(spark):
    paragraphs = [f"Paragraph {i} starts here\nand goes on, é {i}." for i in range(9)]
    whole = "\n\n".join(paragraphs)
    wrapped = "\n".join("> " + w for w in whole.replace("\n\n", "\n").replace("goes", "goes\n").split("\n"))
    chat = spark.createDataFrame([
        (1, 0, "u", whole), (1, 1, "u", "Nothing of it."),
        (1, 2, "u", "\n".join("> " + x for x in whole.split("\n")) + "\nAll nine."),
        (1, 3, "u", "> and goes on, é 4.\nOne line."), (1, 5000, "u", wrapped + "\nWrapped."),
        (1, 5001, "u", "> and goes on, é 4.\n>\n> Paragraph 5 starts here\nAcross a gap."),
        (1, 5002, "u", "> Paragraph 2 starts here\n> and goes on, é 3.\nNot consecutive."), (1, 5003, "u", "> goes on\nPart of a line."),
        (2, 0, "u", "Nothing of it."), (2, 1, "u", "and goes on, é 4.")], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.n_linked, r.parent_turn) for r in quotation.link_quotes(chat).collect()}
    assert got == {(1, 0): (0, None), (1, 1): (0, 0), (1, 2): (1, 0), (1, 3): (1, 0), (1, 5000): (1, 0), (1, 5001): (1, 0),
                   (1, 5002): (0, 5001), (1, 5003): (0, 5002), (2, 0): (0, None), (2, 1): (0, 0)}


def test_attribution_inside_a_quote(spark):
    chat = spark.createDataFrame([
        (1, 0, "A", "First words of A."), (1, 1, "B", "Answer of B.\n\nOn Mon A wrote:\n> First words of A."), (1, 2, "C", "Aside."),
        (1, 3, "A", "Top answer.\n\nOn Tue B wrote:\n> Answer of B.\n>\n> On Mon A wrote:\n>\n>> First words of A."),
        (1, 4, "B", "> > On Mon A wrote:\n> > First words of A.\nOnly attribution above.")], "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.own_text, r.n_quotes, r.n_linked, r.parent_turn) for r in quotation.link_quotes(chat).collect()}
    assert got == {0: ("First words of A.", 0, 0, None), 1: ("Answer of B.", 1, 1, 0), 2: ("Aside.", 0, 0, 1),
                   3: ("Top answer.", 2, 2, 1), 4: ("Only attribution above.", 1, 1, 0)}


def test_reply_order(spark):
    # Message i quotes message `up`; one without a quote answers the turn before.
    rng = random.Random(5)
    rows, parent = [], {}
    for conv, n in ((1, 60), (2, 7), (3, 1)):
        for i in range(n):
            up = rng.randrange(i) if conv == 1 and i > 2 and rng.random() < 0.5 else i - 1
            quote = f"> own {up}.\n" if up != i - 1 else ""
            rows += [(conv, i * 300, "u", f"{quote}own {i}.")] * (2 if i % 10 == 4 else 1)
            parent[conv, i] = up
    rows += [(None, 5, "u", "x"), (None, 5, "u", "x"), (4, None, "u", "y")]
    want = []
    for conv in (1, 2, 3):
        at, stack = 0, [(0, 0)]
        while stack:
            i, depth = stack.pop()
            for _ in range(2 if i % 10 == 4 else 1):
                want.append((conv, i * 300, f"own {i}.", depth, at))
                at += 1
            stack += [(j, depth + 1) for (c, j), up in sorted(parent.items(), reverse=True) if c == conv and up == i]
    want += [(None, 5, "x", None, None)] * 2 + [(4, None, "y", None, None)]
    chat = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r.conv_id, r.turn, r.own_text, r.reply_depth, r.position) for r in quotation.reply_order(quotation.link_quotes(chat)).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert [w[1] for w in want if w[0] == 1] != sorted(w[1] for w in want if w[0] == 1)


def test_long_messages_are_parsed_in_proportion_to_their_lines(spark):
    """A message of very many paragraphs and its reply, which quotes two neighbouring ones."""
    import time
    long = "\n\n".join(f"paragraph number {i}" for i in range(60_000))
    reply = "> paragraph number 41234\n> paragraph number 41235\n\nYes.\n\n" + "\n\n".join(f"> nothing {i}\n\nno {i}" for i in range(5_000))
    chat = spark.createDataFrame([(1, 0, "user", long), (1, 1, "user", "between"), (1, 2, "assistant", reply)],
                                 "conv_id long, turn int, role string, text string")
    began = time.time()
    got = {r.turn: (r.n_quotes, r.n_linked, r.parent_turn) for r in quotation.link_quotes(chat).collect()}
    assert got == {0: (0, 0, None), 1: (0, 0, 0), 2: (5001, 1, 0)}
    assert time.time() - began < 60


def test_runs_of_lines_of_the_wanted_lengths():
    import hashlib
    text = "One two\n\nthree, FOUR\nfive\n\n!!!\nsix"
    lines = ["one two", "three four", "five", "six"]
    runs = {" ".join(lines[i:j]) for i in range(4) for j in range(i + 1, 5)}
    import numpy as np
    for n in range(30):
        want = {hashlib.md5(x.encode()).digest() for x in runs if len(x) == n}
        assert set(quotation.line_runs(text, np.array([n]))) == want
    assert len(quotation.line_runs(text, np.arange(40))) == len(runs) and quotation.line_runs("", np.array([3])) == []
