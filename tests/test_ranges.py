"""Records cut out of byte ranges: the state machines against plain readers, and single files split over many tasks."""
import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from tablewise.sources import ranges as RG
from tablewise.sources import readers as R


def csv_text(rng, rows, end):
    cells = ["a", "", "x y", 'say "hi"', "two\nlines", "tail,", "\r\n", 'mix",\n"', "é", "  lead", '""', "5"]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["k", "b", "c d"])
    for i in range(rows):
        w.writerow([f"r{i}", rng.choice(cells), rng.choice(cells) + str(i)])
    return out.getvalue()


def cut(body: bytes, pieces, exits, records, at: list[int]):
    """What the two passes do, on ranges of pieces that begin at the given places."""
    bounds = [0, *sorted(set(at)), len(pieces)]
    parts, state = [], (0, 0)
    for a, b in zip(bounds, bounds[1:], strict=False):
        parts += list(records(a, iter(pieces[a:b]), *state))
        state = exits(pieces[a:b], *state)
    out, run = [], b""
    for kind, text in parts:
        if kind == RG.WHOLE:
            out.append(text)
        elif kind == RG.OPENS:
            run = text
        elif kind == RG.RUNS_ON:
            run += text
        else:
            out.append(run + text)
            run = b""
    return out + ([run] if run else [])


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_csv_machine_equals_the_csv_module(end):
    for seed in range(60):
        rng = random.Random(seed)
        body = csv_text(rng, rng.randint(0, 12), end)
        if seed % 3 == 0:
            body = body.rstrip("\r\n")
        pieces = body.encode().split(b"\n")
        if pieces[-1] == b"":
            pieces.pop()

        def exits(some, inside, depth):
            for line in some:
                for part in line.split(b"\r"):
                    inside = RG._csv_exit(part, bool(inside))
            return int(inside), 0
        got = cut(body, pieces, exits, lambda a, x, i, d: RG._csv_records(x, bool(i)),
                  [rng.randint(1, max(1, len(pieces) - 1)) for _ in range(rng.randint(0, 5))] if len(pieces) > 1 else [])
        want = [r for r in csv.reader(io.StringIO(body, newline="")) if r]
        assert [next(csv.reader(io.StringIO(x.decode().removesuffix("\n"), newline=""))) for x in got] == want


def test_csv_quotes_inside_fields_are_text():
    assert not RG._csv_exit(b'5" pipe,b', False) and not RG._csv_exit(b'a,b"c"d"', False)
    assert RG._csv_exit(b'a, "open', False) and not RG._csv_exit(b'a,"b"c"', False) and RG._csv_exit(b'x""y', True)
    assert not RG._csv_exit(b'x",y', True) and RG._csv_exit(b'x","y', True) and not RG._csv_exit(b'x",5"', True)


def records_of(rng, n):
    odd = ["}", "{", "]", '"', "\\", '\\"', "},{", "a\nb", "é", ""]
    return [{"k": i, "t": "".join(rng.choices(odd, k=rng.randint(0, 5))), "o": {"x": [1, {"y": rng.choice(odd)}]}} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_machine_equals_the_json_module(indent):
    for seed in range(60):
        rng = random.Random(seed)
        want = records_of(rng, rng.randint(0, 9))
        body = (json.dumps(want, indent=indent, ensure_ascii=False) + rng.choice(["", "\n", " \n "])).encode()
        pieces = body.split(b"}")

        def exits(some, inside, depth):
            for piece in some:
                inside, change = RG._json_exit(piece, bool(inside))
                depth += change - (not inside)
            return int(inside), depth
        at = [rng.randint(1, len(pieces) - 1) for _ in range(rng.randint(0, 5))] if len(pieces) > 1 else []
        got = cut(body, pieces, exits, lambda a, x, i, d: RG._json_records("f", a, x, bool(i), d), at)
        assert [json.loads(RG._one_line(x)) for x in got] == want
        assert exits(pieces, 0, 0) == (0, -1)


def put(folder, name, body):
    path = f"{folder}/{name}"
    with open(path, "wb") as f:
        f.write(body)
    return path


@pytest.fixture()
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_csv_file_in_many_tasks(spark, tmp_out, small_ranges):
    body = csv_text(random.Random(1), 9000, "\r\n").encode()
    path = put(tmp_out, "one.csv", body)
    assert RG._read_pieces(spark, path, "\n").rdd.getNumPartitions() >= 8
    got = R.read_csv(spark, path)
    assert got.columns == ["k", "b", "c d"]
    want = [tuple(x or None for x in r) for r in list(csv.reader(io.StringIO(body.decode(), newline="")))[1:]]
    lead = lambda x: x and (x.lstrip(" ") or None)
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([tuple(map(lead, r)) for r in want], key=str)
    records = RG.csv_records(spark, path)
    assert records.groupBy("start").count().count() >= 8  # records begin in many ranges


def test_one_field_longer_than_many_ranges(spark, tmp_out, small_ranges):
    long = "line of text\n" * 12_000
    path = put(tmp_out, "long.csv", f'a,b\n1,"{long}"\n2,"x\ny"\n3,"{long}"\n'.encode())
    got = {r.a: r.b for r in R.read_csv(spark, path).collect()}
    assert got == {1: long, 2: "x\ny", 3: long}


def test_csv_headers_latin_and_open_ends(spark, tmp_out):
    import os
    os.mkdir(f"{tmp_out}/t.csv")
    put(f"{tmp_out}/t.csv", "a.csv", 'n,t\n1,"ä\nö"\n\n  \n2,"never closed\n'.encode("latin-1"))
    put(f"{tmp_out}/t.csv", "b.csv", 'n,t\n3,5" wide\n4\n'.encode("latin-1"))
    got = sorted((r.n, r.t) for r in R.read_csv(spark, f"{tmp_out}/t.csv").collect())
    assert got[0] == (1, "ä\nö") and got[1][0] == 2 and got[1][1].startswith("never closed") and got[2:] == [(3, '5" wide'), (4, None)]
    path = put(tmp_out, "over.csv", b'a,b\n1,"x\ny",3\n')
    with pytest.raises(ValueError, match="more fields"):
        R.read_csv(spark, path)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_json_array_in_many_tasks(spark, tmp_out, small_ranges, indent):
    rows = records_of(random.Random(2), 4000)
    path = put(tmp_out, "one.json", json.dumps(rows, indent=indent).encode())
    assert RG._read_pieces(spark, path, "}").rdd.getNumPartitions() >= 8
    got = R.read_json(spark, path)
    assert got.columns == ["k", "t", "o"]
    found = [(r.k, r.t, json.loads(r.o.x[1])) for r in got.collect()]
    assert sorted(found, key=str) == sorted([(r["k"], r["t"], r["o"]["x"][1]) for r in rows], key=str)


def test_positions_are_those_of_the_source(spark, tmp_out, small_ranges):
    from tablewise.plans.run import ROW_KEY, in_file_order
    import os
    text = "".join(f'{i},"x{i}\n{"y" * (i % 60)}"\n' for i in range(6000))
    os.mkdir(f"{tmp_out}/o.csv")
    put(f"{tmp_out}/o.csv", "a.csv", ("i,t\n" + text[:40]).rsplit("\n", 1)[0].encode() + b'"\n')
    put(f"{tmp_out}/o.csv", "b.csv", ("i,t\n" + text).encode())
    got = [r.i for r in in_file_order(R.read_csv(spark, f"{tmp_out}/o.csv")).orderBy(ROW_KEY).collect()]
    assert got[-6000:] == list(range(6000)) and got[0] == 0
    path = put(tmp_out, "o.json", json.dumps([{"i": i, "t": "z" * (i % 70)} for i in range(5000)]).encode())
    assert [r.i for r in in_file_order(R.read_json(spark, path)).orderBy(ROW_KEY).collect()] == list(range(5000))


@pytest.mark.parametrize("body", [b"[1, 2]", b'[{"a":1} {"a":2}]', b'[{"a":1},]', b'[{"a":1}', b'[{"a":1}]]', b'[{"a":1}] x', b'[[{"a":1}]]',
                                  b'[{"a":"x\ny"}]', b'[{"a":1},{"a"}]', b'[{"a":1}][{"a":2}]', b'[{"a":{"b":1}]'])
def test_what_is_no_array_of_records_raises(spark, tmp_out, body):
    with pytest.raises(Exception):  # noqa: B017
        R.read_json(spark, put(tmp_out, "bad.json", body)).collect()


def test_the_plan_reads_the_file_in_ranges(spark, tmp_out):
    path = put(tmp_out, "p.csv", csv_text(random.Random(3), 50, "\n").encode())
    plan = RG.csv_records(spark, path)._jdf.queryExecution().toString()
    assert "multiLine" not in plan
    assert R.read_csv(spark, path).where(F.col("k").isNotNull()).count() == 50
