"""Dump readers against the rules of the format, spelled out in plain Python here."""

import os
import random

import pytest
from pyspark.sql import functions as F

from pressmill.catalog import files as catalog_files
from pressmill.functions.fixed import HEADER_KEYS, NOT_AVAILABLE
from pressmill.operators.articles import corpus_rows, split_blocks
from pressmill.sources import dumps as readers
from pressmill.sources.dumps import file_path, load_categories, load_dumps, read_articles, read_blocks, scan_dumps


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode("utf-8"))
    return path


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def expected_blocks(raw: bytes):
    """Line by line: a line that is the mark and blanks separates two blocks."""
    text = raw.decode("utf-8", errors="replace").replace("\r\n", "\n").replace("\r", "\n")
    blocks, current = [], []
    for line in text.split("\n"):
        if line.strip() == "<***>":
            blocks.append("\n".join(current))
            current = []
        else:
            current.append(line)
    return [b.strip() for b in [*blocks, "\n".join(current)]]


def expected_article(block: str):
    header, queue = {}, block.strip().splitlines()
    while queue:
        head = queue[0].strip()
        key, colon, value = head.partition(":")
        if colon and key.rstrip(" ") in HEADER_KEYS:
            value = value.strip()
            header[key.rstrip(" ")] = "" if value in NOT_AVAILABLE else value
        elif head:
            break
        queue.pop(0)
    body = "\n".join(queue).strip()
    if not body:
        return None
    author = next((header[k] for k in ("AUTOR(I)", "AUTORI", "AUTOR") if k in header), "")
    source = header.get("NOVINA", "") or header.get("PORTAL", "")
    return (source, header.get("DATUM", ""), header.get("NASLOV", ""), author, body)


TRICKY = [
    b"",
    b"<***>",
    b"x",
    b"uvod\n<***>\nNOVINA: Avaz\n\nTijelo\n<***>\n",
    b"<***>\r\nNOVINA: A\r\nNASLOV: x\r\n\r\nprvi\r\n<***>\r\nNASLOV: y\r\n\r\ndrugi",
    b"a <***> b\n<***>\nc <***>",
    b"<***> <***>\n<***>\n <***> \n\n<***>",
    b"  <***>\nx\n<***> y\nz\n<***>",
    b"\xef\xbb\xbf<***>\nNASLOV: n\n\ntijelo\n<***>\nNASLOV: m\n\nb",
    b"\xef\xbb\xbf <***>\n<***>",
    b"\xef\xbb\xbf",
    b"<***>\n\xff\xfeNASLOV: q\n\xc4\n<***>\n\xc5\xa1ta",
    b"<***><***>",
    b"a\n<***>\n<***>\n<***>\nb",
    b"a\n\xc2\xa0<***>\xe2\x80\x89\nb\r<***>\rc",
    b"a<***>",
    b"a\n<***>  ",
    b"a\n<***>  x  <***>\nb <***>\n\n\n<***>\n\n",
]


def random_dump(rng):
    parts = ["<***>", "<***>\n", "\n<***>\n", "\n", " ", "\r\n", "NASLOV: t\n", "tekst", " ",
             "AUTORI: a\n", "AUTOR(I):\n", "DATUM : 2005\n", "x <***> y", "č", "\x1c", " "]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 40))).encode("utf-8")


@pytest.fixture(scope="module")
def dump_folder(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("dumps"))
    rng = random.Random(7)
    dumps = [*TRICKY, *(random_dump(rng) for _ in range(100))]
    for i, raw in enumerate(dumps):
        put(folder, f"{i:04d}.txt", raw)
    return folder, dumps


def by_file(df):
    found = {}
    for path, pos, block in rows(df, "path", "pos", "block"):
        found.setdefault(int(os.path.basename(path)[:4]), {})[pos] = block.strip()
    return found


def test_whole_files_give_the_blocks(spark, dump_folder):
    folder, dumps = dump_folder
    found = by_file(split_blocks(scan_dumps(spark, folder)))
    for i, raw in enumerate(dumps):
        if raw:
            want = expected_blocks(raw)
            assert [found[i][p] for p in range(len(want))] == want, raw


@pytest.fixture()
def split_bytes(spark):
    """Sets the size of splits and puts the old one back."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, size)
    spark.conf.set(key, old)


@pytest.mark.parametrize("size", ["16", "134217728"])
@pytest.mark.parametrize("most", [0, 1 << 18])
def test_split_files_give_the_same_articles(spark, dump_folder, split_bytes, monkeypatch, size, most):
    """The same blocks at the same positions, however small the splits are, with and without broadcasts."""
    from pressmill.sources import dumps as module

    folder, dumps = dump_folder
    split_bytes(size)
    small = module.broadcast_if_small
    monkeypatch.setattr(module, "broadcast_if_small", lambda table: small(table, most))
    found = by_file(read_blocks(spark, folder, positions=True))
    for i, raw in enumerate(dumps):
        want = {p: b for p, b in enumerate(expected_blocks(raw)) if b}
        assert {p: b for p, b in found.get(i, {}).items() if b} == want, (i, raw)
    ordered = {}
    for path, *place, block in rows(read_blocks(spark, folder), "path", "cut", "seq", "inner", "block"):
        ordered.setdefault(int(os.path.basename(path)[:4]), []).append((place, block.strip()))
    for i, raw in enumerate(dumps):
        assert [b for _, b in sorted(ordered.get(i, [])) if b] == [b for b in expected_blocks(raw) if b], (i, raw)


def scanned_files(df):
    """Files that the scans of a finished plan have opened."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_ruled_out_files_are_not_opened(spark, folder, split_bytes):
    for i in range(6):
        put(folder, f"{'avaz_ai' if i < 2 else 'avaz'}{i}/x{'_ai' if i < 2 else ''}.txt", f"<***>\nNASLOV: a\n\ntijelo {i}" * 5)
    split_bytes("16")
    kept = read_blocks(spark, folder, files=file_path().like("%\\_ai.txt"))
    assert kept.count() > 2
    assert len(kept.collect()) and scanned_files(kept) == 2


def test_plain_dumps_are_read_without_a_shuffle(spark, folder, capsys):
    for i in range(4):
        put(folder, f"{i}.txt", "<***>\r\nNASLOV: a\r\n\r\ntijelo\r\n <***>\nNASLOV: b\n\ndrugo <***> tu\n" * 50)
    articles = load_dumps(spark, folder, 0)
    articles.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan
    assert articles.count() == 400


def test_articles(spark, dump_folder):
    folder, dumps = dump_folder
    got = rows(
        read_articles(spark, folder), "source_name", "date", "title", "author", "text"
    )
    want = [expected_article(b) for raw in dumps for b in expected_blocks(raw)]
    assert sorted(got) == sorted(w for w in want if w)


def test_header_rules(spark, folder):
    put(folder, "a.txt", (
        "<***>\nNOVINA: \nPORTAL: Buna\nNASLOV: stari\n\nNASLOV : novi\nAUTOR(I): N/A\n"
        "AUTORI: Neko\nLINK: http://a.example/x:y\nDATUM: 11902005\n\nPrvi red\n\nautor: q\n"
        "<***>\nNASLOV: samo zaglavlje\n<***>\n"
    ))
    got = read_articles(spark, folder).collect()
    assert len(got) == 1
    a = got[0]
    assert (a.source_name, a.title, a.author) == ("Buna", "novi", "")
    assert a.link == "http://a.example/x:y"
    assert a.text == "Prvi red\n\nautor: q"
    row = corpus_rows(read_articles(spark, folder), 1, include_title=True).first()
    assert (row.label, row.source, row.year) == (1, "buna", 1902)
    assert row.text == "novi. Prvi red\n\nautor: q"


def test_no_files(spark, folder):
    with pytest.raises(FileNotFoundError):
        load_dumps(spark, folder, 0)
    with pytest.raises(FileNotFoundError):
        load_categories(spark, folder)


def test_bom_is_kept_unless_asked(spark, folder):
    put(folder, "a.txt", b"\xef\xbb\xbf<***>\nNOVINA: A\n\ntijelo")
    kept = load_dumps(spark, folder, 0).first()
    assert kept.source == "unknown" and kept.text.startswith(chr(0xFEFF) + "<***>")
    read = load_dumps(spark, folder, 0, strip_bom=True).first()
    assert (read.source, read.text) == ("a", "tijelo")


def test_categories(spark, folder):
    body = "<***>\nNOVINA: {}\nDATUM: 1.1.2024\n\ntekst {}"
    put(folder, "Karikature i stripovi/a.txt", body.format("X", 1))
    put(folder, "Društvo/a.txt", body.format("", 2))
    put(folder, "a+b/x%20y.txt", body.format("Č. List", 3))
    put(folder, "a+b/deeper/no.txt", body.format("X", 4))
    put(folder, "prazno/readme.md", "nothing")
    put(folder, "direct.txt", body.format("X", 5))
    got = rows(load_categories(spark, folder, default_source="arhiva"), "category", "source", "text")
    assert sorted(got) == [("Društvo", "arhiva", "tekst 2"), ("a+b", "c_list", "tekst 3")]
    everything = load_categories(spark, folder, exclude=set())
    assert {r.category for r in everything.collect()} == {
        "Društvo", "a+b", "Karikature i stripovi"
    }
    unlabelled = load_categories(spark, folder, label=None, fallback=False)
    assert "label" not in unlabelled.columns and unlabelled.count() == 2


def test_category_fallback_to_the_base_folder(spark, folder):
    put(folder, "arhiva/a.txt", "<***>\nDATUM: 2001\n\ntekst")
    base = os.path.join(folder, "arhiva")
    assert rows(load_categories(spark, base), "category", "year") == [("arhiva", 2001)]
    with pytest.raises(FileNotFoundError):
        load_categories(spark, base, fallback=False)


def test_no_fallback_beside_subfolders(spark, folder):
    put(folder, "arhiva/a.txt", "<***>\nDATUM: 2001\n\ntekst")
    base = os.path.join(folder, "arhiva")
    os.makedirs(os.path.join(base, "prazno"))
    with pytest.raises(FileNotFoundError):
        load_categories(spark, base)


def test_categories_without_articles(spark, folder):
    put(folder, "a/a.txt", "<***>\nNASLOV: samo zaglavlje")
    put(folder, "Karikature i stripovi/a.txt", "tekst")
    with pytest.raises(FileNotFoundError):
        load_categories(spark, folder)
    assert load_categories(spark, folder, exclude={"a"}).count() == 1


def test_large_dump_goes_on_in_further_files(spark, folder, monkeypatch):
    """A dump in parts holds the blocks and articles of one file, in order."""
    monkeypatch.setattr(catalog_files, "PART_BYTES", 2000, raising=False)
    rows = [(i, f"<***>\nNOVINA: list\nLINK: {i}\n\nTekst {i} <***> kraj\nred") for i in range(200)]
    rows += [(None, None), (7, None), (203, None)]
    df = spark.createDataFrame(rows, "article_id long, article string").repartition(5)
    catalog_files._write_dump(df, f"{folder}/d", "izvod")
    assert readers.list_files(spark, f"{folder}/d").count() > 1
    counts = readers.count_blocks(read_blocks(spark, f"{folder}/d")).agg(F.sum("n_blocks"), F.sum("n_articles")).first()
    assert tuple(counts) == (201, 200)
    got = read_articles(spark, f"{folder}/d").orderBy("path", *readers.PLACE).collect()
    assert [(r.link, r.text) for r in got] == [(str(i), f"Tekst {i} <***> kraj\nred") for i in range(200)]


def test_many_splits_in_few_tasks(spark, folder):
    """Small splits stay small, and a task reads many of them."""
    for i in range(40):
        put(folder, f"bucket={i}/d.txt", f"<***>\n\nred {i}\n" * 20000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with catalog_files.many_splits(spark, folder):
        scan = readers.scan_pieces(spark, folder)
        tasks, splits = scan.rdd.getNumPartitions(), scan.select("path", "cut").distinct().count()
    assert tasks <= 40 < 120 <= splits
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
