import datetime as dt
import gzip
import json
import random
from pathlib import Path

import pytest

from tests.conftest import rows
from tidemark.plans import warehouse
from tidemark.sources import raw, tables
from tidemark.streaming.landing import fact_stream, land_stream

EVENT = {"id": "1", "type": "PushEvent", "actor": {"id": 5, "login": "ann"}, "repo": {"id": 9, "name": "o/r"},
         "payload": {"size": 1, "ref": "é"}, "public": True, "created_at": "2024-01-14T01:00:00Z"}


def event(id_, **changes):
    return json.dumps({k: v for k, v in (EVENT | {"id": id_} | changes).items() if v is not ...}, ensure_ascii=False)


def put(root: Path, day: str, hour: int, *lines: str, cut: bool = False, content: bytes | None = None) -> None:
    folder = root / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    data = content if content is not None else gzip.compress("".join(f"{x}\n" for x in lines).encode())
    (folder / f"{hour}.json.gz").write_bytes(data[: len(data) // 2] if cut else data)


def parsed(spark, *lines):
    return raw.parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"))


@pytest.mark.parametrize("line, good", [
    (event("1"), True),
    ("  " + event("1") + "  \n", True),
    ("{}", True),
    ("", False),
    ("   ", False),
    ('{"id": "1"', False),
    ('{"id": "1"} rest', False),
    ('{"id": "1"}{"id": "2"}', False),
    ('{"id": "1"},{"id": "2"}', False),
    ('{"id": "1"}}', False),
    ('{"id": "1"}]}', False),
    ('{"id": "1"},', False),
    ("{'id': '1'}", False),
    ("{id: 1}", False),
    ("[1, 2]", False),
    ("5", False),
    ("null", False),
    ('"text"', False),
    ('{"id": "1", "actor": "ann"}', False),
    (None, False),
])
def test_line_verdict(spark, line, good):
    assert (parsed(spark, line).first().event is not None) is good


def test_one_parse_per_line(spark):
    lines = spark.createDataFrame([(event("1"),)], "line string").selectExpr("line", "current_date() dt", "1 hour")
    plan = raw.ods_rows(raw.parse_lines(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def landed_rows(spark, *lines):
    df = parsed(spark, *lines).selectExpr("event", "date'2024-01-14' dt", "1 hour")
    return [r.asDict() for r in raw.ods_rows(df).collect()]


def test_defaults(spark):
    full, bare, nulls = landed_rows(
        spark, event("1", org={"id": 3, "login": "acme"}), "{}",
        event("2", actor=None, repo=None, org=None, payload=None, public=None, created_at=None))
    assert full["org_id"] == 3 and full["org_login"] == "acme" and full["is_public"] is True
    assert full["payload"] == '{"size":1,"ref":"é"}'
    for row in (bare, nulls | {"event_id": "", "event_type": ""}):
        assert (row["event_id"], row["event_type"], row["actor_login"], row["repo_name"], row["created_at"]) == ("",) * 5
        assert [row[c] for c in ("actor_id", "repo_id", "org_id", "org_login", "is_public", "payload")] == [None] * 6


def test_numeric_id_becomes_text(spark):
    assert landed_rows(spark, '{"id": 12345678901234567890}')[0]["event_id"] == "12345678901234567890"


@pytest.fixture
def zone(tmp_path):
    root = tmp_path / "raw"
    put(root, "2024-01-14", 0, event("a"), "", "{broken", "[1]", "7", event("b"))
    put(root, "2024-01-14", 13, event("c"))
    put(root, "2024-01-14", 14, *[event(f"cut{i}") for i in range(5000)], cut=True)
    put(root, "2024-01-15", 1)
    put(root, "2024-01-16", 2, content=b"not gzip at all")
    put(root, "2024-01-16", 3, content=gzip.compress(event("bytes").encode().replace("é".encode(), b"\xff")))
    return root


def test_integrity(spark, zone):
    got = {(str(r.dt), r.hour): r for r in raw.gzip_integrity(raw.raw_files(spark, str(zone))).collect()}
    assert {k for k, r in got.items() if not r.ok} == {("2024-01-14", 14), ("2024-01-16", 2)}
    assert got["2024-01-14", 14].error.startswith("EOFError")
    assert got["2024-01-14", 0].line_cnt == 6 and got["2024-01-15", 1].line_cnt == 0
    assert got["2024-01-16", 3].line_cnt == 1  # no newline at the end


def test_listing_reads_no_content(spark, zone):
    plan = raw.raw_files(spark, str(zone)).select("path", "dt", "hour")._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Project")[1].split("\n")[0]


def test_land(spark, zone, tmp_path):
    ods = str(tmp_path / "ods")
    done = warehouse.land(spark, str(zone), ods)
    assert (done.lines, done.bad_lines, done.broken_files) == (8, 4, 2)
    assert {(str(r.dt), r.hour) for r in done.broken.collect()} == {("2024-01-14", 14), ("2024-01-16", 2)}
    stored = spark.read.parquet(ods)
    assert {r.event_id for r in stored.collect()} == {"a", "b", "c", "bytes"}
    assert stored.filter("event_id = 'bytes'").first().payload == '{"size":1,"ref":"�"}'
    assert rows(tables.stored_partitions(spark, ods, "dt", "hour")) == [
        (dt.date(2024, 1, 14), 0), (dt.date(2024, 1, 14), 13), (dt.date(2024, 1, 16), 3)]


def test_land_again_takes_new_and_changed_hours_only(spark, zone, tmp_path):
    ods = str(tmp_path / "ods")
    warehouse.land(spark, str(zone), ods)
    before = sorted(p.name for p in Path(ods).rglob("hour=0/*.parquet"))
    put(zone, "2024-01-14", 14, event("d"))
    put(zone, "2024-01-14", 13, event("changed"))
    again = warehouse.land(spark, str(zone), ods)
    assert (again.lines, again.broken_files) == (2, 1)
    assert {r.event_id for r in spark.read.parquet(ods).collect()} == {"a", "b", "changed", "d", "bytes"}
    assert sorted(p.name for p in Path(ods).rglob("hour=0/*.parquet")) == before
    warehouse.land(spark, str(zone), ods, overwrite=True)
    assert {r.event_id for r in spark.read.parquet(ods).collect()} == {"a", "b", "changed", "d", "bytes"}


def test_nothing_new(spark, tmp_path):
    root, ods = tmp_path / "raw", str(tmp_path / "ods")
    put(root, "2024-01-14", 0, event("a"))
    warehouse.land(spark, str(root), ods)
    assert warehouse.land(spark, str(root), ods).lines == 0


def test_hour_states(spark, zone, tmp_path):
    ods = str(tmp_path / "ods")
    before = {r.state for r in warehouse.hour_states(spark, str(zone), ods).collect()}
    assert before == {"pending", "damaged", "missing"}
    warehouse.land(spark, str(zone), ods)
    got = {(str(r.dt), r.hour): r.state for r in warehouse.hour_states(spark, str(zone), ods).collect()}
    assert len(got) == 72
    named = {k: v for k, v in got.items() if v != "missing"}
    assert named == {("2024-01-14", 0): "landed", ("2024-01-14", 13): "landed", ("2024-01-14", 14): "damaged",
                     ("2024-01-15", 1): "landed",  # an empty file has no line to land
                     ("2024-01-16", 2): "damaged", ("2024-01-16", 3): "landed"}
    one_day = warehouse.hour_states(spark, str(zone), ods, "2024-01-17", "2024-01-17")
    assert {r.state for r in one_day.collect()} == {"missing"} and one_day.count() == 24


def _account(value) -> bool:
    if value is None:
        return True
    return isinstance(value, dict) and (value.get("id") is None or type(value["id"]) is int)


def _is_event(text: str) -> bool:
    """One JSON object whose parts have the envelope's types."""
    try:
        found = json.loads(text)
    except ValueError:
        return False
    return (isinstance(found, dict) and all(_account(found.get(k)) for k in ("actor", "repo", "org"))
            and (found.get("public") is None or isinstance(found["public"], bool)))


def test_random_damage_is_judged_as_by_a_json_parser(spark):
    """Characters deleted or inserted, ends repeated or cut off, at random places of sound lines."""
    chance = random.Random(7)
    lines = []
    for i in range(4000):
        line = event(str(i), org={"id": i, "login": "ö"})
        for _ in range(chance.randint(0, 2)):
            at = chance.randrange(len(line) + 1)
            line = chance.choice([line[:at] + line[at + 1:], line[:at] + chance.choice('{}[]",: 1nté\\') + line[at:],
                                  line + line[at:], line[:at]])
        lines.append(line)
    table = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    got = {r.n: r.event is not None for r in raw.parse_lines(table).collect()}
    assert [x for i, x in enumerate(lines) if got[i] != _is_event(x)] == []
    assert 1000 < sum(got.values()) < 3000


@pytest.mark.parametrize("line", [
    '{"id": "1"}],"end":"x"}', '{"id": "1"}],"lines":[{"id": "2"}', '{"id": "1"}], "more": [{"id": "2"}', '{"id": "1"} /* */',
    '{"id": "1"}, "end": "y"'])
def test_spliced_lines_are_bad(spark, line):
    assert parsed(spark, line).first().event is None


@pytest.mark.parametrize("streamed", [False, True])
def test_rows_of_archived_files_stay(spark, tmp_path, streamed):
    """A file that was landed and moved away keeps its rows; a changed one replaces its own alone."""
    root, ods = tmp_path / "raw", str(tmp_path / "ods")

    def run():
        if streamed:
            land_stream(spark, str(root), ods, str(tmp_path / "cp"), hour_folders=True).awaitTermination()
        else:
            warehouse.land(spark, str(root), ods)
        return sorted(r.event_id for r in spark.read.parquet(ods).collect())

    put_part(root, 1, "one", event("1"), event("2"))
    assert run() == ["1", "2"]
    (root / "dt=2024-01-14" / "hour=1" / "one.json.gz").rename(tmp_path / "one.json.gz")
    put_part(root, 1, "two", event("3"))
    put_part(root, 2, "two", event("4"))
    assert run() == ["1", "2", "3", "4"]
    states = {r.hour: r.state for r in warehouse.hour_states(spark, str(root), ods).collect()}
    assert (states[1], states[2], states[3]) == ("landed", "landed", "missing")
    put_part(root, 2, "three", event("5"), cut=True)
    assert run() == ["1", "2", "3", "4"]
    put_part(root, 2, "three-again" if streamed else "three", event("5"))  # a stream sees new names only
    assert run() == ["1", "2", "3", "4", "5"]


def test_a_file_that_turns_up_damaged_keeps_what_was_landed(spark, tmp_path):
    root, ods = tmp_path / "raw", str(tmp_path / "ods")
    put(root, "2024-01-14", 0, event("a"), event("b"))
    warehouse.land(spark, str(root), ods)
    put(root, "2024-01-14", 0, event("a"), event("c"), cut=True)
    assert warehouse.land(spark, str(root), ods).broken_files == 1
    assert sorted(r.event_id for r in spark.read.parquet(ods).collect()) == ["a", "b"]
    assert {r.state for r in warehouse.hour_states(spark, str(root), ods).collect()} == {"damaged", "missing"}


def test_each_file_is_opened_once(tmp_path, monkeypatch):
    """Lines and verdict come from one stream, in pieces, also for a file of many pieces."""
    import pyarrow as pa

    put(tmp_path, "2024-01-14", 0, *[event(str(i)) for i in range(30_000)])
    path = f"file:{tmp_path}/dt=2024-01-14/0.json.gz"
    opened = []
    monkeypatch.setattr(raw, "open_file", lambda p, own=raw.open_file: opened.append(p) or own(p))
    batch = pa.RecordBatch.from_pydict({"path": [path], "dt": [None], "hour": [0], "length": [1], "modificationTime": [None],
                                        "content": pa.array([None], pa.binary())})
    found = list(raw._unpack_files(iter([batch])))
    assert opened == [path] and len(found) > 3
    assert sum(len(b) for b in found[:-1]) == 30_000 == found[-1].column("line_cnt")[0].as_py()
    assert max(b.nbytes for b in found) < 8 << 20


def test_storage_errors_are_no_damage(tmp_path):
    from tidemark.sources.files import StorageError, open_file

    with pytest.raises(StorageError):
        open_file(f"file:{tmp_path}/absent.gz")


def put_part(root: Path, hour: int, part: str, *lines: str, cut: bool = False) -> None:
    folder = root / "dt=2024-01-14" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    data = gzip.compress("".join(f"{x}\n" for x in lines).encode())
    (folder / f"{part}.json.gz").write_bytes(data[: len(data) // 2] if cut else data)


@pytest.mark.parametrize("streamed", [False, True])
def test_late_and_repaired_files_of_a_landed_hour(spark, tmp_path, streamed):
    root, ods = tmp_path / "raw", str(tmp_path / "ods")

    def run():
        if streamed:
            land_stream(spark, str(root), ods, str(tmp_path / "cp"), hour_folders=True, files_per_batch=1).awaitTermination()
        else:
            warehouse.land(spark, str(root), ods)
        states = {r.hour: r.state for r in warehouse.hour_states(spark, str(root), ods).collect()}
        return sorted(r.event_id for r in spark.read.parquet(ods).collect()), states[1]

    put_part(root, 1, "one", event("a"), "{bad")
    put_part(root, 1, "two", event("b"), cut=True)
    put_part(root, 2, "one", event("x"))
    put_part(root, 2, "two", event("y"))
    assert run() == (["a", "x", "y"], "damaged")
    volume = {str(r.dt): r for r in warehouse.ingest_volume(spark, str(root), ods).collect()}
    for r in (volume["2024-01-14"], volume["None"]):
        assert (r.raw_files, r.damaged_files, r.hours, r.lines, r.bad_lines, r.rows) == (4, 1, 2, 4, 1, 3)
    put_part(root, 1, "two-again" if streamed else "two", event("b"))
    if streamed:
        (root / "dt=2024-01-14" / "hour=1" / "two.json.gz").unlink()
    put_part(root, 2, "late", event("z"))
    assert run() == (["a", "b", "x", "y", "z"], "landed")
    assert run() == (["a", "b", "x", "y", "z"], "landed")


def test_an_hour_that_empties(spark, tmp_path):
    root, ods = tmp_path / "raw", str(tmp_path / "ods")
    put(root, "2024-01-14", 0, event("a"))
    put(root, "2024-01-14", 1, event("b"))
    warehouse.land(spark, str(root), ods)
    put(root, "2024-01-14", 1, "{no event")
    warehouse.land(spark, str(root), ods)
    assert [r.event_id for r in spark.read.parquet(ods).collect()] == ["a"]


def test_lines_end_in_any_way(spark, tmp_path, monkeypatch):
    text = "one\r\ntwo\rthree\n\nfünf".encode() + b"\xff\nlast"
    expected = ["one", "two", "three", "", "fünf\ufffd", "last"]
    for size in (1, 2, 3, 5, 100):
        pieces, rest = [], text
        while rest:
            n = size
            while rest[:n].endswith(b"\r") and n < len(rest):
                n += 1
            pieces.append(rest[:n])
            rest = rest[n:]
        assert [x for block in raw._lines(pieces) for x in block.to_pylist()] == expected
    root = tmp_path / "raw"
    put(root, "2024-01-14", 0, content=gzip.compress(text))
    (checked,) = raw.gzip_integrity(raw.raw_files(spark, str(root))).collect()
    assert checked.line_cnt == len(expected)
    *lines, verdict = raw.unpacked(raw.raw_files(spark, str(root))).collect()
    assert [r.line for r in lines] == expected and not any(r.done for r in lines)
    assert (verdict.done, verdict.error, verdict.line_cnt, verdict.text_bytes) == (True, None, len(expected), len(text))


def test_volume(spark, zone, tmp_path):
    ods = str(tmp_path / "ods")
    warehouse.land(spark, str(zone), ods)
    got = {str(r.dt): r for r in warehouse.ingest_volume(spark, str(zone), ods).collect()}
    assert (got["2024-01-14"].raw_files, got["2024-01-14"].hours, got["2024-01-14"].rows) == (3, 2, 3)
    assert (got["2024-01-15"].rows, got["2024-01-15"].ratio, got["2024-01-15"].bytes_per_row) == (0, None, None)
    sizes = sum(p.stat().st_size for p in Path(ods).rglob("dt=2024-01-14/**/*.parquet"))
    assert got["2024-01-14"].stored_bytes == sizes and got["2024-01-14"].bytes_per_row == sizes / 3


def test_one_file_per_hour_with_zstd(spark, zone, tmp_path):
    import pyarrow.parquet as pq

    ods = str(tmp_path / "ods")
    warehouse.land(spark, str(zone), ods)
    for folder in Path(ods).glob("dt=*/hour=*"):
        (file,) = folder.glob("file=*/*.parquet")
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_bad_line_report(spark):
    report = raw.bad_line_report(parsed(spark, event("1"), "", "{x"))
    assert tuple(report.first()) == (3, 2)


def test_stream_lands_and_resumes(spark, tmp_path):
    root, ods, fact = tmp_path / "raw", str(tmp_path / "ods"), str(tmp_path / "fact")
    put(root, "2024-01-14", 0, event("a"), "{bad")
    put(root, "2024-01-14", 1, event("cut"), cut=True)

    def run():
        land_stream(spark, str(root), ods, str(tmp_path / "cp1")).awaitTermination()
        fact_stream(spark, ods, fact, str(tmp_path / "cp2")).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(fact).collect())

    assert run() == ["a"]
    put(root, "2024-01-15", 0, event("b"))
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
