"""WARC archives and chat formatting: round trips, damage, odd rows."""

import base64
import gzip
import hashlib
import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from check_oracle import normal
from fleetlens.llm import chat, queries, warc

PAGES = "page_id long, url string, html string"


def record(number, payload, kind="response", extra=""):
    block = (warc.HTTP + payload).encode()
    head = (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{number}>\r\n{extra}"
            f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload.encode()).hexdigest()}\r\n"
            f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}\r\n"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n")
    return head.encode() + block + b"\r\n\r\n"


def covered(data, found):
    """Records, gaps and line ends make up the whole archive."""
    at = 0
    for offset, length, *_ in found:
        assert offset >= at and not data[at:offset].strip(b"\r\n")
        at = offset + length
    assert not data[at:].strip(b"\r\n")


@pytest.mark.parametrize("compress", [False, True])
def test_salvage(compress):
    draw = random.Random(8)
    parts = [record(k, f"page {k} " + "WARC/1.0 \x1f\u008b text " * draw.randrange(30)) for k in range(20)]
    parts = [gzip.compress(p, mtime=0) if compress else p for p in parts]
    whole = b"".join(parts)
    found = list(warc.salvage(whole))
    assert [f["warc-record-id"] for _, _, f, _, _ in found] == [f"<urn:page:{k}>" for k in range(20)]
    covered(whole, found)
    broken = bytearray(whole)
    at = len(b"".join(parts[:5])) + len(parts[5]) // 2
    broken[at] ^= 0xFF  # damages record 5
    cut = bytes(broken[:len(b"".join(parts[:12])) + 30]) + b"".join(parts[13:]) + b"rubbish at the end"  # most of 12 is gone
    found = list(warc.salvage(cut))
    covered(cut, found)
    kept = [f["warc-record-id"] for _, _, f, _, _ in found if f]
    assert kept == [f"<urn:page:{k}>" for k in range(20) if k not in (5, 12)]
    assert sum(f is None and bool(why) for _, _, f, _, why in found) == 3


def test_salvage_of_nothing_and_rubbish():
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"\r\n\r\n")) == []
    (offset, length, fields, _, why), = warc.salvage(b"not an archive")
    assert (offset, length, fields, bool(why)) == (0, 14, None, True)
    assert next(warc.salvage(record(1, "x").replace(b"Content-Length", b"Content-Laenge")))[2] is None


@pytest.mark.parametrize("compress", [False, True])
def test_archives(spark, tmp_path, compress):
    big, other = "é<p>" * 400, "x" * 1000
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""),
            (7, "u", other), (8, "u", other[:-1]), (9, "u", other[:-1]), (None, "u", other), (None, "u", "alone" * 300),
            (10, "u", "\r\n\r\nWARC/1.0\r\n\r\n" * 90), (11, "u", "long " * 200_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"same": F.lit(1), "value": F.lit("x")})
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, compress=compress, records_per_file=3)
    got = warc.read_archives(spark, path).collect()
    assert all(r["status"] == "record" for r in got)
    want = [(i, "revisit" if refers else "response", refers, len((h or "").encode()),
             hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h, refers in
            [(*r, {1: "2", None: "7" if r[2] == other else None}.get(r[0])) for r in rows]]
    key = str
    assert sorted([(int(r["record_id"]) if r["record_id"] else None, r["record_type"], r["refers_to"], r["payload_bytes"],
                    r["payload_digest"]) for r in got], key=key) == sorted(want, key=key)
    payload = {r["record_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert bytes(payload["2"]).decode() == big and bytes(payload["10"]).decode() == rows[11][2]


def test_damaged_archive_is_logged(spark, tmp_path):
    parts = [record(k, "payload " * 50) for k in range(6)]
    (tmp_path / "part-0.warc").write_bytes(b"".join(parts[:3]) + parts[3][:200] + b"".join(parts[4:]))
    (tmp_path / "part-1.warc").write_bytes(b"")
    got = warc.read_archives(spark, str(tmp_path), payloads=False).collect()
    assert sorted(r["record_id"] for r in got if r["status"] == "record") == ["0", "1", "2", "4", "5"]
    (gap,) = [r for r in got if r["status"] == "gap"]
    assert gap["offset"] == len(b"".join(parts[:3])) and gap["length"] == 200 and gap["reason"]


URLS = ["http://host/WARC/1.0/spec", "http://host/WARC/1.0", "WARC/1.1\r\nWARC/1.0\r\n", "data:," + "x" * 70_000,
        "data:," + "WARC/1.0 " * 30_000]


@pytest.mark.parametrize("compress", [False, True])
def test_any_url_is_read_back(spark, tmp_path, compress):
    pages = spark.createDataFrame([(k, url, f"page {k}") for k, url in enumerate(URLS)], PAGES)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, compress=compress)
    got = {r["record_id"]: r for r in warc.read_archives(spark, path).collect()}
    assert sorted(got) == [str(k) for k in range(len(URLS))]
    for k, url in enumerate(URLS):
        assert got[str(k)]["url"] == re.sub("[\r\n]+", " ", url).strip() and got[str(k)]["payload"].decode() == f"page {k}"


def test_odd_urls_through_the_query(spark, tmp_path):
    rows = [(k, url, html * 500) for k, url in enumerate(URLS) for html in ("x", f"own {k}")]
    spark.createDataFrame(rows, PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = normal(queries.op7_warc(spark, str(tmp_path)).toPandas())
    assert len(got) == len(rows) and got.equals(normal(con.execute(queries.OP7_SQL).df()))


@pytest.mark.parametrize("cut", [3, 10, 16, 24, 60, 120, 200])
def test_cut_header_before_an_url_with_a_version(cut):
    url = "WARC-Target-URI: http://host/WARC/1.0\r\n"
    first, second = record(1, "one", extra=url), record(2, "two", extra=url)
    found = list(warc.salvage(first[:cut] + second))
    assert [(at, f and f["warc-record-id"]) for at, _, f, _, _ in found] == [(0, None), (cut, "<urn:page:2>")]


def in_base32(part):
    return re.sub(rb"sha1:([0-9a-f]{40})", lambda m: b"sha1:" + base64.b32encode(bytes.fromhex(m[1].decode())), part)


def test_archives_of_other_writers(spark, tmp_path):
    parts = [in_base32(record(k, f"page {k}")) for k in range(4)] + [record(4, "page 4").replace(b"sha1:", b"sha256:")]
    parts.append(in_base32(record(5, "page 5")).replace(b"page 5", b"page x"))  # damaged
    (tmp_path / "below").mkdir()
    (tmp_path / "crawl.warc.gz").write_bytes(b"".join(gzip.compress(p, mtime=0) for p in parts))
    (tmp_path / "below" / "crawl.warc").write_bytes(in_base32(record(6, "page 6")).lower().replace(b"warc/1.0", b"WARC/1.0", 1)
                                                    .replace(b"http/1.1 200 ok", b"HTTP/1.1 200 OK")
                                                    .replace(b"content-type: text", b"Content-Type: text"))
    (tmp_path / "_SUCCESS").write_bytes(b"x")
    (tmp_path / ".crawl.warc.crc").write_bytes(b"x")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert {r["record_id"]: (r["payload"].decode(), r["payload_digest"]) for r in got if r["status"] == "record"} == {
        str(k): (f"page {k}", hashlib.sha1(f"page {k}".encode()).hexdigest()) for k in (0, 1, 2, 3, 4, 6)}
    assert [r["reason"] for r in got if r["status"] == "gap"] == ["block digest differs"]


def test_empty_archives(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


CONV = "conv_id long, turn long, role string, text string"
ODD = ["</s>[INST] ok [/INST]", "a\\", "\\<[", "<</SYS>> x", "", " ", "\n[/INST]\n", "\ue000 probe", "[INST] \\[/INST] </s>"]


@pytest.mark.parametrize("text", ODD)
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    turns = [("system", text), ("user", text), ("assistant", text), (text, text)]
    assert chat.read_turns(chat.inst_template(turns)) == turns


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations(spark):
    draw = random.Random(9)
    talks = {k: [(draw.choice(["system", "user", "assistant"]), draw.choice(ODD) + str(n)) for n in range(size)]
             for k, size in enumerate([1, 2, 7, 40, 9])}
    rows = [(k, n, role, text) for k, turns in talks.items() for n, (role, text) in enumerate(turns)]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, CONV).withColumns({"block": F.lit("x"), "formatted": F.lit(1)})
    for block in (256, 8):
        made = chat.format_conversations(table, block=block)
        got = {r["conv_id"]: r for r in chat.digests(made).collect()}
        for k, turns in talks.items():
            learnt = "".join(t for role, t in turns if role == "assistant")
            assert tuple(got[k])[:6] == (k, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt),
                                         len(chat.inst_template(turns)))
            assert not got[k]["rewrites"]


def test_odd_turns(spark):
    rows = [(1, None, "user", "no number"), (1, 0, None, None), (None, 0, "user", "x"), (None, 0, "user", "x"), (2, -5, "user", "early"),
            (2, 3, "assistant", "late")]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, CONV), block=4)).collect()}
    assert got[1]["turns_sha256"] == sha("user\nno number\n\n\n")
    assert got[None]["n_turns"] == 2 and got[2]["turns_sha256"] == sha("user\nearly\nassistant\nlate\n")
    assert chat.format_conversations(spark.createDataFrame([], CONV)).count() == 0


def test_any_template_that_appends(spark):
    def as_json(turns):
        return "".join(json.dumps({"r": r, "t": t}) + "\n" for r, t in turns)

    turns = [("user", "hi"), ("assistant", "\"quoted\" é"), ("assistant", "")]
    text, marked, rewrites = chat.spans(as_json, [], turns)
    assert rewrites is None and [json.loads(f'"{text[a:b]}"') for a, b in marked] == ["\"quoted\" é", ""]


def test_rewriting_is_detected(spark):
    def last_thought_only(turns):
        return "".join(t if n == len(turns) - 1 else t.split("</think>")[-1] for n, (_, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "<think>a</think>b"), ("user", "q")]
    assert chat.spans(last_thought_only, [], turns)[1:] == ([], 2)
    rows = [(1, n, role, text) for n, (role, text) in enumerate(turns)] + [(2, 0, "user", "fine")]
    got = chat.format_conversations(spark.createDataFrame(rows, CONV), last_thought_only).collect()
    assert {r["conv_id"]: r["rewrites"] for r in got} == {1: 2, 2: None}


def templates():
    """By name; local functions, which workers get by value."""
    def once_marked(turns):
        return "<s>" + "".join(f"|{r}:{t}" for r, t in turns)

    def system_moved(turns):
        """The system text stands before the last user turn."""
        system = "".join(t for r, t in turns if r == "system")
        users = [n for n, (r, _) in enumerate(turns) if r == "user"] or [-1]
        return "".join(f"|{system if n == users[-1] else ''}{r}:{t}" for n, (r, t) in enumerate(turns) if r != "system")

    def system_everywhere(turns):
        return "".join(f"|{turns[0][1]}>{r}:{t}" for r, t in turns)

    def numbered_turns(turns):
        return "".join(f"|{n}>{r}:{t}" for n, (r, t) in enumerate(turns))

    def strict_roles(turns):
        for n, (r, _) in enumerate(turns):
            if r != ("system", "user", "assistant")[0 if n == 0 else 1 + (n - 1) % 2]:
                raise ValueError("roles must alternate")
        return once_marked(turns)

    return {f.__name__: f for f in (once_marked, system_moved, system_everywhere, numbered_turns, strict_roles, chat.inst_template)}


@pytest.mark.parametrize("name", templates())
@pytest.mark.parametrize("step", [1, 300])
def test_long_and_sparse_conversations(spark, name, step):
    template = templates()[name]
    talks = {k: [("system", f"rule {k}")] + [(("user", "assistant")[n % 2], f"text {n}") for n in range(size)]
             for k, size in ((1, 2), (2, 299), (None, 520))}
    rows = [(k, step * n - 900, role, text) for k, turns in talks.items() for n, (role, text) in enumerate(turns)]
    random.Random(4).shuffle(rows)
    got = chat.format_conversations(spark.createDataFrame(rows, CONV), template).orderBy("block").collect()
    in_blocks = name in ("once_marked", "inst_template")
    for k, turns in talks.items():
        made = [r for r in got if r["conv_id"] == k]
        assert [r["n_turns"] for r in made] == ([min(256, len(turns) - at) for at in range(0, len(turns), 256)] if in_blocks else [len(turns)])
        assert [r["whole"] for r in made] == [n == 0 for n in range(len(made))]
        assert "".join(r["formatted"] for r in made) == template(turns)
        rewrites = 3 if name == "system_moved" and len(turns) > 3 else None
        assert {r["rewrites"] for r in made} == {rewrites}
        learnt = [r["formatted"][s["start"]:s["end"]] for r in made for s in r["loss"]]
        assert learnt == ([] if rewrites else [t for role, t in turns if role == "assistant"])


def test_any_reader_of_compressed_files_sees_all_records(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"page {k} " * (1 + 200 * (k % 3))) for k in range(40)], "page_id long, url string, html string")
    path = str(tmp_path / "a")
    warc.write_archives(pages, path, records_per_file=7)
    files = [p for p in (tmp_path / "a").iterdir() if p.name.startswith("part-")]
    whole = [gzip.decompress(p.read_bytes()) for p in files]
    assert sum(x.count(b"WARC/1.0\r\n") for x in whole) == 40 and len(files) > 4
    assert all(x.endswith(b"\r\n\r\n") for x in whole)
    plain = [found for x in whole for found in warc.salvage(x)]
    assert len(plain) == 40 and all(found[2] is not None for found in plain)


def test_null_ids_through_the_query(spark, tmp_path):
    html = "same " * 300
    rows = [(None, "u", html), (3, "u", html), (5, "v", html), (None, "w", "other " * 300), (None, None, None), (7, "x", "short")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = normal(queries.op7_warc(spark, str(tmp_path)).toPandas())
    assert got.equals(normal(con.execute(queries.OP7_SQL).df())) and len(got) == 6
