"""Warnings of rows, counted per file."""

from longform.plans.parse_warnings import parse_warnings


def test_each_warning(spark, tmp_path, small_splits):
    files = {
        "vendor_a.csv": b"meta\na,b,c\n1,2,3\n1,2\n\n1,2,3,4\n,,\n1\n",
        "vendor_b.csv": b'a,b,c\n1,"x\ny",3\n4,"never closed\n5,6,7\n',
        "vendor_c.csv": b"a,b,c\n1,\xff,3\n" + b"1,2,3\n" * 60,
        "vendor_d.csv": b"nothing here\n",
        "vendor_e.csv": b"a,b,c\n",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = {r.file_name: r for r in parse_warnings(spark, str(tmp_path), threshold=3).collect()}
    counts = lambda n: (rows[n].row_count, rows[n].short_rows, rows[n].long_rows, rows[n].blank_lines, rows[n].unclosed_quotes, rows[n].invalid_bytes, rows[n].warnings)
    assert counts("vendor_a.csv") == (6, 2, 1, 1, 0, 0, 0b00111)
    assert counts("vendor_b.csv") == (2, 1, 0, 0, 1, 0, 0b01001)
    assert counts("vendor_c.csv") == (61, 0, 0, 0, 0, 1, 0b10000)
    assert counts("vendor_d.csv") == (None,) * 7 and rows["vendor_d.csv"].error == "Could not find header row."
    assert counts("vendor_e.csv") == (0, 0, 0, 0, 0, 0, 0) and len(rows) == 5
