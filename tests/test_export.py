"""CSV export: heading row, CRLF line ends, quotes doubled, dd.MM.yyyy, JSON tags."""

import glob
import tempfile

from custfold.operators import activate as A
from custfold.plans import pipeline

from conftest import SMALL


def test_export_csv_format(spark):
    m = pipeline.master_table(spark, SMALL)
    exp = A.export_members(m)
    out = tempfile.mkdtemp(prefix="custfold-export-", dir="/tmp")
    A.write_export_csv(exp, out + "/csv")
    heading = "Email Address,First Name,Last Name,Nationality,Birthday,Tag,AllowEmail"
    body = []
    for part in sorted(glob.glob(out + "/csv/part-*.csv")):
        text = open(part, newline="").read()
        lines = text.split("\r\n")
        assert lines[0] == heading
        assert "\n" not in text.replace("\r\n", "")
        body += [ln for ln in lines[1:] if ln]
    assert len(body) == m.count()
    first = body[0]
    assert '"[""' in first          # JSON tag array, quotes doubled inside a quoted field
    emails = [ln.split(",")[0] for ln in body]
    assert emails == sorted(emails)
