import pytest

from sparkload.sources.copytext import CORRUPT
from sparkload.sources.delimited import profile_delimited, read_delimited


def write(folder, text, name="t.csv"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_header_gives_names(spark, tmp_path):
    df = read_delimited(spark, write(tmp_path, "name, age ,city\nAlice,30,NYC\nBob,25,SF\n"), header=True)
    assert df.columns == ["name", "age", "city"]
    assert rows(df) == [("Alice", "30", "NYC"), ("Bob", "25", "SF")]


def test_generated_names_and_first_row_is_data(spark, tmp_path):
    df = read_delimited(spark, write(tmp_path, "1,hello,3.14\n2,world,2.71\n"))
    assert df.columns == ["col_1", "col_2", "col_3"] and len(rows(df)) == 2


def test_null_if(spark, tmp_path):
    path = write(tmp_path, "A,NULL,B\nNULL,,C\n")
    assert rows(read_delimited(spark, path, null_if_values=["NULL"])) == [("A", None, "B"), (None, None, "C")]
    kept = read_delimited(spark, path, null_if_values=["NULL"], keep_empty=True)
    assert rows(kept) == [("A", None, "B"), (None, "", "C")]


def test_given_columns_win_over_the_header(spark, tmp_path):
    path = write(tmp_path, "1,2,3\n4,5,6\n")
    assert read_delimited(spark, path, columns=["a", "b", "c"]).columns == ["a", "b", "c"]
    assert rows(read_delimited(spark, path, columns=["a", "b", "c"], header=True)) == [("4", "5", "6")]


def test_tab_delimiter_quotes_and_blank_lines(spark, tmp_path):
    path = write(tmp_path, '1\t"a\tb"\n\n2\t"say ""hi"""\n')
    assert rows(read_delimited(spark, path, delimiter="\t")) == [("1", "a\tb"), ("2", 'say "hi"')]


def test_empty_file(spark, tmp_path):
    path = write(tmp_path, "")
    assert read_delimited(spark, path).count() == 0
    assert read_delimited(spark, path, columns=["a"]).count() == 0


def test_comment_before_the_header(spark, tmp_path):
    df = read_delimited(spark, write(tmp_path, "# note\n\nid,v\n#x\n1,a\n"), header=True, comment="#")
    assert df.columns == ["id", "v"] and rows(df) == [("1", "a")]


def test_skip_header_comment_per_file(spark, tmp_path):
    for i in range(3):
        write(tmp_path, f"exported\nby x,y,z\n# note\nid,v\n{i},a\n{i},b\n", f"d/{i}.csv")
    df = read_delimited(spark, str(tmp_path / "d"), skip_records=2, header=True, comment="#")
    assert df.columns == ["id", "v"]
    assert sorted(rows(df)) == [(str(i), v) for i in range(3) for v in "ab"]


def test_skip_does_not_depend_on_split_size(spark, tmp_path):
    path = write(tmp_path, "x\n" + "".join(f"{i},v{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_delimited(spark, path, skip_records=1)
        assert df.rdd.getNumPartitions() > 4
        assert sorted(int(r.col_1) for r in df.collect()) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_multiline(spark, tmp_path):
    path = write(tmp_path, 'skip me\na,"x\ny",c\n1,"",3\n')
    assert rows(read_delimited(spark, path, multiline=True, skip_records=1)) == [("a", "x\ny", "c"), ("1", None, "3")]


def test_ragged_rows(spark, tmp_path):
    path = write(tmp_path, "1,2\n3\n4,5,6\n")
    kept = read_delimited(spark, path, on_ragged="reject")
    assert sorted(rows(kept), key=str) == sorted([("1", "2", None), (None, None, "3"), (None, None, "4,5,6")], key=str)
    assert kept.select(CORRUPT).where(f"{CORRUPT} is not null").count() == 2
    with pytest.raises(Exception, match="expected 2 fields"):
        read_delimited(spark, path).count()
    with pytest.raises(Exception, match="expected 2 fields"):
        read_delimited(spark, path).select("col_1").collect()


def test_encoding(spark, tmp_path):
    path = tmp_path / "l1.csv"
    path.write_bytes("naïve,é\n1,ü\n".encode("latin-1"))
    df = read_delimited(spark, str(path), header=True, encoding="ISO-8859-1")
    assert df.columns == ["naïve", "é"] and rows(df) == [("1", "ü")]


def test_strict_and_lazy_quotes(spark, tmp_path):
    path = write(tmp_path, 'a,"b"x,d\n')
    assert rows(read_delimited(spark, path, lazy_quotes=True)) == [("a", '"b"x', "d")]
    with pytest.raises(Exception):
        read_delimited(spark, path).collect()


def test_other_quotes_and_none(spark, tmp_path):
    path = write(tmp_path, "'a,b','it\\'s',c\n1,2,3\n")
    assert rows(read_delimited(spark, path, quote_char="'", escape="\\"))[0] == ("a,b", "it's", "c")
    path = write(tmp_path, 'a"b,"c\n"d,e\n', "q.csv")
    assert rows(read_delimited(spark, path, quote_char="")) == [('a"b', '"c'), ('"d', "e")]


def test_profile(spark, tmp_path):
    vectors = {
        "pipe": ("name|age|city\nAlice|30|NYC\nBob|25|SF\n", "|", True, 3),
        "tab": ("a\tb\tc\n1\t2\t3\n4\t5\t6\n", "\t", True, 3),
        "two_columns": ("a;b\n1;2\n", ",", True, 1),
        "one_line": ("x,y,z", ",", False, 3),
        "numeric_head": ("1^2^3^4\r\n5^6^7^8\r\n", "^", False, 4),
        "ten_lines_only": ("a,b,c\n" * 10 + ";;;;;;;;;;;;;;;;;;;;;;;;;;;;;;;;;;\n" * 50, ",", True, 3),
        "empty_cell": (",b,c\n1,2,3\n", ",", True, 3),
        "tie": ("a,b,c;d;e\n", ",", False, 3),
    }
    for name, (text, *_) in vectors.items():
        write(tmp_path, text, f"p/{name}")
    write(tmp_path, "", "p/empty")
    got = {r.file.rsplit("/", 1)[1]: (r.delimiter, r.header, r.n_cols) for r in profile_delimited(spark, str(tmp_path / "p")).collect()}
    assert got == {name: tuple(want) for name, (_, *want) in vectors.items()}


def test_profile_reads_long_lines_whole_and_compressed_files(spark, tmp_path):
    import gzip

    long_line = ",".join(["x" * 50_000] * 4)
    write(tmp_path, f"{long_line}\n1,2,3,4\n", "p/long.csv")
    with gzip.open(tmp_path / "p" / "z.csv.gz", "wt") as f:
        f.write("a|b|c\n1|2|3\n")
    got = {r.file.rsplit("/", 1)[1]: (r.delimiter, r.n_cols) for r in profile_delimited(spark, str(tmp_path / "p")).collect()}
    assert got == {"long.csv": (",", 4), "z.csv.gz": ("|", 3)}


def test_profile_does_not_read_file_contents_when_listing(spark, tmp_path):
    write(tmp_path, "a,b,c\n", "p/x")
    plan = profile_delimited(spark, str(tmp_path / "p"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan and "Exchange" not in plan


def test_names_after_many_lines_of_remarks(spark, tmp_path):
    remark = '"' + "\n".join(["a remark"] * 150) + '"\n'
    path = write(tmp_path, "# note\n" * 150 + "id,v\n1,a\n2,b\n")
    assert rows(read_delimited(spark, path, header=True, comment="#")) == [("1", "a"), ("2", "b")]
    path = write(tmp_path, remark + "id,v\n1,a\n2,b\n", "remark.csv")
    assert rows(read_delimited(spark, path, header=True, skip_records=1)) == [("1", "a"), ("2", "b")]


def test_no_names_in_a_file_with_bytes_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no record"):
        read_delimited(spark, write(tmp_path, "# a\n# b\n"), header=True, comment="#")
    assert read_delimited(spark, write(tmp_path, "", "none.csv")).columns == []


@pytest.mark.parametrize("size", ["37", "64", "4096"])
def test_quoted_newlines_over_any_splits(spark, tmp_path, size):
    text = "".join(f'{i},"a {i}\n\nb, ""{i}""\n# no comment\n","{"long " * (i % 13)}\nend"\n# "comment\n' for i in range(60))
    path = write(tmp_path, text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        df = read_delimited(spark, path, comment="#", trim=False, skip_records=3)
        got = sorted(rows(df), key=lambda r: int(r[0]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(str(i), f'a {i}\n\nb, "{i}"\n# no comment\n', f"{'long ' * (i % 13)}\nend") for i in range(3, 60)]


def test_skip_over_several_splits(spark, tmp_path):
    path = write(tmp_path, "".join(f"{i},v{i}\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted(int(r.col_1) for r in read_delimited(spark, path, skip_records=2000).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(range(2000, 4000))


def test_carriage_returns(spark, tmp_path):
    text = 'a\rb,"c\rd"\r\n"e\r\nf",g\r\n\r\nh,i'
    got = rows(read_delimited(spark, write(tmp_path, text), trim=False))
    assert got == [("a\rb", "c\rd"), ("e\nf", "g"), ("h", "i")]


BROKEN = ['1,"a"b', '2,c"d', '3,"x', '"a" ,4', '""",5']


@pytest.mark.parametrize("line", BROKEN)
@pytest.mark.parametrize("multiline", [None, False])
def test_broken_quotes_fail_or_are_rejects(spark, tmp_path, line, multiline):
    path = write(tmp_path, f'0,ok\n6,"o ""k"""\n{line}\n')
    kept = rows(read_delimited(spark, path, columns=["a", "b"], on_ragged="reject", multiline=multiline))
    assert sorted(kept, key=str) == sorted([("0", "ok", None), ("6", 'o "k"', None), (None, None, line)], key=str)
    with pytest.raises(Exception, match="bad quotes"):
        read_delimited(spark, path, columns=["a", "b"], multiline=multiline).collect()


def test_open_quote_without_newlines_allowed(spark, tmp_path):
    path = write(tmp_path, '1,"a\nx,b"\n2,c\n')
    assert rows(read_delimited(spark, path)) == [("1", "a\nx,b"), ("2", "c")]
    rejects = rows(read_delimited(spark, path, columns=["a", "b"], on_ragged="reject", multiline=False))
    assert [r[2] for r in rejects if r[2]] == ['1,"a', 'x,b"']


def test_headers_must_agree(spark, tmp_path):
    write(tmp_path, "id,name\n1,a\n", "h/1.csv")
    write(tmp_path, "name,id\nz,9\n", "h/2.csv")
    with pytest.raises(ValueError, match="headers differ"):
        read_delimited(spark, str(tmp_path / "h"), header=True)
    write(tmp_path, '"id", name\n1,a\n', "g/1.csv")
    write(tmp_path, "id,name\n2,b\n", "g/2.csv")
    assert sorted(rows(read_delimited(spark, str(tmp_path / "g"), header=True, lazy_quotes=False))) == [("1", "a"), ("2", "b")]


def test_fields_of_all_kinds(spark, tmp_path):
    text = 'a,"b ""c"", d",e\r\n"","x\ny",\r\n"1",2,"3"\n,,\nlast,"line\n\n",end'
    got = rows(read_delimited(spark, write(tmp_path, text), trim=False))
    assert got == [("a", 'b "c", d', "e"), (None, "x\ny", None), ("1", "2", "3"), (None, None, None), ("last", "line\n\n", "end")]
