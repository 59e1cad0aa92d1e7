import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from wavelake.operators.rejects import laid_out, load_lines, load_texts, parse_block, record_ends, rejects, structural_index, valid_rows

CLASSES = pa.array(["Cat_meow", "Dog"])
MIDS = pa.array(["/m/1"])


def reasons(line, name="dev.csv"):
    return parse_block(*laid_out(pa.array([line], pa.string())), name, CLASSES if name == "dev.csv" else MIDS)["reasons"].to_pylist()[0]


def test_lines_of_the_first_layout():
    assert reasons('12,"Dog,Cat_meow",train') == []
    assert reasons('"12",Dog,"val"') == []
    assert reasons("12,Dog,Cat_meow,train") == ["column_count"]
    assert reasons("12,Dog") == ["column_count"]
    assert reasons("") == ["column_count"] and reasons(None) == ["column_count"]
    assert reasons('12,""Dog"",train') == ["quoting"]
    assert reasons('1"2,Dog,train') == ["quoting"]
    assert reasons('12,"Dog"x,train') == ["quoting"]
    assert reasons('12,"Dog,train') == ["quoting"]
    assert reasons("fname,labels,split") == ["fname_value", "labels_value", "split_value"]
    assert reasons('12,"Dog, Cat_meow",train') == ["labels_value"]
    assert reasons("12,,train") == ["labels_value"]
    assert reasons('12,"Do""g",train') == ["labels_value"]
    assert reasons("١٢,Dog,train ") == ["fname_value", "split_value"]


def test_lines_of_the_second_layout():
    t = "audioset_train_strong.tsv"
    assert reasons("a\t0\t1.5e+00\t/m/1", t) == []
    assert reasons('a\t0\t1\t"/m/1"', t) == []
    for a, b in (("-1", "2"), ("nan", "2"), ("0:08", "9"), ("2", "2"), ("3", "1"), ("1", "1e999"), ("+1", "2"), (" 1", "2"), ("", "2"), ("1", "٣")):
        assert reasons(f"a\t{a}\t{b}\t/m/1", t) == ["time_value"]
    assert reasons("a\t0\t1\t/m/2", t) == ["label_value"]
    assert reasons("a\tx\ty\t", t) == ["time_value", "label_value"]
    assert reasons("a,0,1,/m/1", t) == ["column_count"]
    assert reasons("x", "other.csv") == ["file_name"]


FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a,"é\t', max_size=12), min_size=1, max_size=5))
def test_structure_equals_a_grammar(lines):
    buf, ends = laid_out(pa.array(lines))
    begins, cuts, bad = structural_index(buf, ends, ",")
    for i, line in enumerate(lines):
        well = re.fullmatch(f"{FIELD}(?:,{FIELD})*", line) is not None
        assert bad[i] == (not well)
        if well:
            n = len(re.findall(f",{FIELD}", "," + line))
            assert ((cuts >= begins[i]) & (cuts < ends[i])).sum() + 1 == n


def test_tables(spark):
    labels = spark.createDataFrame([("Dog", "/m/1", 0), ("Cat_meow", "/m/2", 1)], "class_name string, mid string, label_idx int")
    rows = [(1, "dev.csv", 1, '7,"Dog,Cat_meow",val', "x"), (2, "dev.csv", 2, "x,Dog,y", "x"), (3, "audioset_train_strong.tsv", 1, "v\t0.5\t1\t/m/2", "x"), (4, None, 1, "a", "x"), (5, "dev.csv", 3, None, "x")]
    lines = spark.createDataFrame(rows, "line_id bigint, file_name string, line_no bigint, line string, reasons string")
    got = load_lines(lines, labels)
    assert sorted((r[0], r[1]) for r in rejects(got).collect()) == [(2, "fname_value"), (2, "split_value"), (4, "file_name"), (5, "column_count")]
    v = {r["line_id"]: r for r in valid_rows(got).collect()}
    assert v[1]["labels"] == ["Dog", "Cat_meow"] and v[1]["start_time_seconds"] is None
    assert v[3]["end_time_seconds"] == 1.0 and v[3]["fname"] is None
    assert load_lines(lines.limit(0), labels).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a,"\n', max_size=6), min_size=1, max_size=3), min_size=1, max_size=5))
def test_record_ends_are_found(records):
    written = [",".join('"' + v.replace('"', '""') + '"' for v in r) for r in records]
    raw = ("\n".join(written) + "\n").encode()
    ends = record_ends(np.frombuffer(raw, np.uint8))
    begins = [0, *(ends[:-1] + 1)]
    assert [raw[a:b].decode() for a, b in zip(begins, ends)] == written


def test_texts_with_records_over_lines(spark):
    labels = spark.createDataFrame([("Dog\nbig", "/m/1")], "class_name string, mid string")
    texts = spark.createDataFrame([("dev.csv", b'1,"Dog\nbig",val\r\n2,Dog,val\n3,"Dog'), ("dev.csv", None), (None, b"a")], "file_name string, content binary")
    got = sorted((r["file_name"] or "", r["record_no"], r["reasons"], r["labels"], r["record"]) for r in load_texts(texts, labels).collect())
    assert got == [("", 0, ["file_name"], None, "a"), ("dev.csv", 0, [], ["Dog\nbig"], None), ("dev.csv", 1, ["labels_value"], None, "2,Dog,val"), ("dev.csv", 2, ["quoting"], None, '3,"Dog')]
