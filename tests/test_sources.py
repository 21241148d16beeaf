"""Packages cut anywhere, archives read member by member."""

import json
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderloom.sources import archives, packages, sources

C = F.col
HARD = ['a "quoted" } { [ ] text', "back\\slash \\\\", "\\", '"', "}{", '{"releases": [', "città 日本 🙂", "", "x" * 300, 'ends with \\"', "\\u007d"]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "0"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def release(rng, k):
    text = lambda: "".join(rng.choice(HARD) for _ in range(rng.randint(0, 3)))
    lots = [{"id": f"L{k}-{j}", "title": text()} for j in range(rng.randint(0, 4))]
    out = {"ocid": f"o{k}", "date": text(), "tender": {"title": text(), "description": text(), "lots": lots}, "parties": [{"name": text(), "roles": ["buyer"]}]}
    if rng.random() < 0.1:
        del out["tender"]
    return out


def package(rng, n, first=0, **how):
    own = [release(rng, first + k) for k in range(n)]
    before = {"uri": 'a "b" {', "extensions": ["x", "{"], "publisher": {"name": "p", "a": {"releases": [{"ocid": "inner"}]}}, "links": [{"ocid": "other", "tender": {"title": "t"}}]}
    whole = before | {"releases": own} | {"license": "}", "more": [{"ocid": "after", "tender": {}}], "version": [[{"ocid": "deep"}]]}
    return own, json.dumps(whole, **how)


def shape(r):
    return (r["ocid"], r["date"], r["tender"]["title"], r["tender"]["description"], tuple((x["id"], x["title"]) for x in r["tender"]["lots"]))


def test_ranges_anywhere_give_the_same_releases(spark, tmp_path, small_ranges):
    rng, want = random.Random(1), {}
    for k, how in enumerate([{}, {"indent": 3}, {"ensure_ascii": False}, {"separators": (",", ":"), "ensure_ascii": False}]):
        own, text = package(rng, 60, 1000 * k, **how)
        (tmp_path / f"p {k}.json").write_text(text + "\n" * (k % 2), encoding="utf-8")
        want[f"p {k}.json"] = sorted(shape(r) for r in own if "tender" in r)
    (tmp_path / "empty.json").write_text(json.dumps({"releases": []}))
    (tmp_path / "none.json").write_text("")
    long, text = package(rng, 3, 9000)
    long[1]["tender"]["description"] = "y { " * 3000  # a release over many ranges
    (tmp_path / "long.json").write_text(json.dumps({"releases": long}))
    want["long.json"] = sorted(shape(r) for r in long if "tender" in r)
    got = sources.read_releases(spark, str(tmp_path))
    found = {}
    for r in got.collect():
        found.setdefault(r.source_file, []).append(shape(r.asDict(True)))
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in want.items() if v}
    at, files = packages.places(spark, str(tmp_path))
    assert at.count() > 100 and {r.kind for r in files.collect()} == {"package"}
    assert packages.chunks(spark, str(tmp_path)).rdd.getNumPartitions() > 10


def test_truncated_files_give_no_rows(spark, tmp_path, small_ranges):
    """Cut at every kind of place: in a string, an escape, a character of several bytes, behind a brace, before the last one."""
    _, text = package(random.Random(2), 12, ensure_ascii=False)
    raw = text.encode()
    for k, cut in enumerate([*range(len(raw) - 24, len(raw)), *range(400, len(raw), 3977)]):
        (tmp_path / f"t{k}.json").write_bytes(raw[:cut])
    (tmp_path / "two.json").write_bytes(raw + b"\n" + raw)
    (tmp_path / "whole.json").write_bytes(raw)
    got = sources.read_releases(spark, str(tmp_path))
    assert [r.source_file for r in got.select("source_file").distinct().collect()] == ["whole.json"]


def test_effects_compose(spark):
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(['"', "{", "}", "[", "]", "\\", "a", '"releases": [', ","]) for _ in range(40)).encode() + b"}"
        at = [i + 1 for i, b in enumerate(text) if b == 0x7D]  # ranges begin behind a brace
        whole = packages.Effect(packages.np.frombuffer(text, packages.np.uint8))
        parts = [packages.Effect(packages.np.frombuffer(text[a:b], packages.np.uint8)) for a, b in zip([0, *at], at)]
        out = parts[0]
        for p in parts[1:]:
            out = out.then(p)
        assert (out.bytes, out.parity) == (whole.bytes, whole.parity)
        assert out.row() == whole.row()


def test_gzipped_package(spark, tmp_path):
    import gzip

    own, text = package(random.Random(4), 5)
    (tmp_path / "p.json.gz").write_bytes(gzip.compress(text.encode()))
    assert sources.read_releases(spark, str(tmp_path)).count() == sum("tender" in r for r in own)


def test_tolerant_kinds_of_files(spark, tmp_path, small_ranges):
    own, text = package(random.Random(5), 20)
    one, two = ({"ocid": k, "tender": {"title": "t }{"}, "buyer": {"name": "b"}} for k in ("one", "two"))
    (tmp_path / "package.json").write_text(text)
    (tmp_path / "bare.json").write_text(json.dumps(one, indent=2))
    (tmp_path / "lines.json").write_text("\n".join([json.dumps(one), "bad", json.dumps(two), "", '{"x": 1}', json.dumps({"releases": [two]})]))
    got = sources.read_releases_tolerant(spark, str(tmp_path)).collect()
    assert sorted(r.ocid for r in got if r.source_file == "package.json") == sorted(r["ocid"] for r in own)
    assert [r.ocid for r in got if r.source_file == "bare.json"] == ["one"]
    assert sorted((r.ocid or "", r.bad or "") for r in got if r.source_file == "lines.json") == [("", "bad"), ("", '{"x": 1}'), ("one", ""), ("two", ""), ("two", "")]


def test_members_of_archives(spark, tmp_path, monkeypatch):
    """Many members, odd names and bytes, a large member in small batches, an archive with a broken member."""
    with zipfile.ZipFile(tmp_path / "a b=1.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.json", "1\n2\r\n\n3")
        z.writestr("dir/", "")
        z.writestr("dir/y.json", b"caf\xe9\n")
        z.writestr("z.txt", "not asked for")
        z.writestr("x.json", "again")
        z.writestr("empty.json", "")
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("big.json", "w", force_zip64=True) as f:
        for k in range(30_000):
            f.write(b"line %d\n" % k)
    raw = (tmp_path / "big.zip").read_bytes()
    (tmp_path / "broken.zip").write_bytes(raw[:5000] + bytes(200) + raw[5200:])
    (tmp_path / "no.zip").write_text("text")
    members = sources.members_of(spark, str(tmp_path), suffix=".json")
    assert sorted((r.file, r.member) for r in members.collect()) == [("a b=1.zip", "dir/y.json"), ("a b=1.zip", "empty.json"), ("a b=1.zip", "x.json"), ("a b=1.zip", "x.json"), ("big.zip", "big.json"), ("broken.zip", "big.json")]
    lines = sources.read_zipped_lines(spark, str(tmp_path), suffix=".json")
    got = lines.collect()
    assert [r.line for r in got if r.file == "big.zip"] == [f"line {k}" for k in range(30_000)]
    assert sorted(r.line for r in got if r.file == "a b=1.zip") == sorted(["1", "2", "", "3", "caf�", "again"])
    assert 0 < sum(r.file == "broken.zip" for r in got) < 30_000
    assert lines.rdd.getNumPartitions() > 1
    bad = {r.file: (r.lines, r.malformed) for r in sources.malformed_lines(lines.filter("file != 'broken.zip'")).collect()}
    assert bad == {"a b=1.zip": (5, 5), "big.zip": (30_000, 30_000)}


def test_written_archives_come_back(spark, tmp_path):
    df = spark.createDataFrame([("a.zip", "m.json", '{"cig": "1"}\nbroken'), ("b.zip", "m.json", None)], "name string, member string, text string")
    assert archives.write_archives(df, f"file:{tmp_path}/out") == 2 and archives.write_archives(df, f"{tmp_path}/out") == 2
    assert [r.cig for r in sources.read_lot_codes(spark, f"{tmp_path}/out").collect()] == ["1"]
    assert [(r.lines, r.malformed) for r in sources.malformed_lines(sources.read_zipped_lines(spark, f"{tmp_path}/out")).collect()] == [(2, 1)]


def test_rows_joined_with_braces():
    values = pa.array(["skip", "a", None, "é", ""]).slice(1)
    assert packages.joined(values).tobytes().decode() == "a}}é}}"


def test_nested_blocks_of_a_tag(spark):
    """Against the standard library's parser: nested, unclosed, stray, commented and scripted tags."""
    from html.parser import HTMLParser

    class Blocks(HTMLParser):
        def __init__(self, html, tag):
            super().__init__()
            self.tag, self.open, self.found, self.html = tag, [], [], html
            self.lines = [0]
            for line in html.splitlines(True):
                self.lines.append(self.lines[-1] + len(line))
            self.feed(html)
            self.close()

        def at(self):
            line, column = self.getpos()
            return self.lines[line - 1] + column

        def handle_starttag(self, tag, attrs):
            if tag == self.tag:
                self.open.append(len(self.found))
                self.found.append([self.at() + len(self.get_starttag_text()), len(self.html)])

        def handle_endtag(self, tag):
            if tag == self.tag and self.open:
                self.found[self.open.pop()][1] = self.at()

    rng = random.Random(6)
    parts = ["<div>", '<div class="a">', "</div>", "</DIV >", "<p>", "</p>", "text ", "<!-- <div> -->", "<script>'<div>'</script>", "<divider>", "\n", "<a href='x'>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for page in pages:
        assert sources.tag_blocks(page, "div") == [page[a:b] for a, b in Blocks(page, "div").found]
    df = spark.createDataFrame([(1, '<li>one<ul><li>two <a href="u">x</a></li></ul></li>'), (2, None), (3, "<li>open")], "id int, html string")
    got = [(r.id, r.block, r.text, r.link) for r in sources.html_blocks(df, "id", "html", "li", "o").orderBy("id", "block").collect()]
    assert got == [(1, 0, "one two x", "u"), (1, 1, "two x", "u"), (3, 0, "open", None)]


def test_packages_lie_in_one_folder(spark):
    """A reader lists one folder, however many packages there are."""
    from compare import SMALL

    from tenderloom.queries import feeds

    files = spark.read.format("binaryFile").load(feeds.written_packages(spark, SMALL)).select("path").collect()
    assert len(files) > 1 and len({r.path.rsplit("/", 1)[0] for r in files}) == 1


def test_many_archives_of_one_task(spark, tmp_path):
    """All archives that one task holds are written, and read back."""
    from tenderloom.sources import archives

    path = str(tmp_path / "a")
    texts = spark.range(40).coalesce(1).selectExpr("concat('x', id, '.zip') AS name", "'m.json' AS member", "repeat('y', 1000) AS text")
    assert archives.write_archives(texts, path) == 40
    assert archives.member_lines(archives.members_of(spark, path)).filter("length(line) = 1000").count() == 40


def test_packages_take_little_room(spark):
    """Packages are written by the tasks that make their releases, gzipped: neither their texts nor shuffles of these are the most of the disk."""
    from compare import SMALL

    from tenderloom.operators import nested as N
    from tenderloom.queries import feeds, nested

    text = N.packed_json(*nested.release_rows(spark, SMALL)).agg(F.sum(F.length("json")), F.count("*")).first()
    stages = lambda: {x.stageId(): x.shuffleWriteBytes() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None))}
    store = spark.sparkContext._jsc.sc().statusStore()
    for extra_lines in (False, True):
        before = stages()
        path = feeds.written_packages(spark, SMALL, extra_lines)
        moved = sum(n for k, n in stages().items() if k not in before)
        files = spark.read.format("binaryFile").load(path).agg(F.sum("length"), F.count("*")).first()
        assert files[0] + moved < text[0] / 3 and text[1] / feeds.PER_FILE <= files[1] <= text[1] / feeds.PER_FILE + 4
        got = sources.read_releases_tolerant(spark, path)
        assert got.filter("ocid is not null").select("ocid").distinct().count() == text[1] == got.filter("ocid is not null").count()
        assert (got.filter("bad is not null").count() > 0) == extra_lines


def test_gzipped_files_are_read_like_others(spark, tmp_path):
    import gzip

    own, text = package(random.Random(8), 20)
    one = json.dumps({"ocid": "one", "tender": {"title": "t }{"}})
    for folder, suffix, pack in (("plain", "", bytes), ("packed", ".gz", gzip.compress)):
        (tmp_path / folder).mkdir()
        for name, x in {"package.txt": text, "lines.txt": f"{one}\n{one}\n{{ broken", "one.txt": f"{one}\n{{ broken", "bare.txt": one, "cut.txt": text[:-30]}.items():
            (tmp_path / folder / f"{name}{suffix}").write_bytes(pack(x.encode()))
    plain, packed = (sorted((r.source_file.removesuffix(".gz"), r.ocid or "", r.bad or "") for r in sources.read_releases_tolerant(spark, str(tmp_path / x)).collect()) for x in ("plain", "packed"))
    assert plain == packed and len(plain) > 20


def test_files_are_read_twice(spark, tmp_path, small_ranges):
    """Effects are stored; a pass for fragments only where a file has several ranges."""
    own, text = package(random.Random(9), 3)
    reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")
    (tmp_path / "long.json").write_text(text)
    assert reads(sources.read_releases(spark, str(tmp_path))) == 2
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{k}", "4m")
    got = sources.read_releases(spark, str(tmp_path))
    assert reads(got) == 1 and sorted(r.ocid for r in got.collect()) == sorted(r["ocid"] for r in own if "tender" in r)
