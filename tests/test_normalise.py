"""The landing step: one job over all sites, and where an invalid record lies."""

import pytest

from batchgate import land
from batchgate.errors import InvalidRecord
from batchgate.operators.contract import DEFAULT


def landed_rows(path, site):
    rows = []
    for part in sorted((path / f"hospital_{site}.csv").glob("part-*")):
        lines = part.read_bytes().decode().split("\n")
        assert lines[0] == ",".join(DEFAULT.columns) and lines[-1] == ""
        rows += lines[1:-1]
    return rows


def raw_rows(delivery, site):
    return delivery.file(site).read_bytes().decode().split("\r\n")[1:-1]


def test_all_sites_in_order(spark, delivery, tmp_path):
    target = tmp_path / "landed"
    for _ in range(2):  # the second time over the first one's files
        land(spark, str(delivery), str(target))
        for site in DEFAULT.sites:
            assert landed_rows(target, site) == raw_rows(delivery, site)
            control = (target / f"hospital_{site}.rows").read_bytes()
            assert control == delivery.control(site).read_bytes()
        assert [p.name for p in target.iterdir() if p.name.startswith(".landing")] == []


def test_a_site_with_a_header_only(spark, delivery, tmp_path):
    delivery.write("B", [])
    land(spark, str(delivery), str(tmp_path / "landed"))
    assert landed_rows(tmp_path / "landed", "B") == []
    assert landed_rows(tmp_path / "landed", "A") == raw_rows(delivery, "A")


@pytest.mark.parametrize("spanning", [False, True])
def test_first_invalid_record(spark, delivery, tmp_path, spanning):
    target = tmp_path / "landed"
    land(spark, str(delivery), str(target))
    before = landed_rows(target, "A")
    for site, at in (("B", 4), ("A", 30), ("A", 20)):
        lines = delivery.file(site).read_bytes().split(b"\r\n")
        lines[at] += b",more"
        if spanning and site == "A" and at == 20:
            lines[5] = b'"a\r\nb"' + lines[5][lines[5].index(b","):]
        delivery.file(site).write_bytes(b"\r\n".join(lines))
    with pytest.raises(InvalidRecord) as caught:
        land(spark, str(delivery), str(target))
    assert (caught.value.site, caught.value.line) == ("A", 22 if spanning else 21)
    assert "SYN" not in str(caught.value)
    # What was landed before stays.
    assert landed_rows(target, "A") == before


def test_quoted_line_ends(spark, delivery, tmp_path):
    lines = delivery.file("A").read_bytes().split(b"\r\n")
    lines[3] = b'"a\r\nb"' + lines[3][lines[3].index(b","):]
    delivery.file("A").write_bytes(b"\r\n".join(lines))
    land(spark, str(delivery), str(tmp_path / "landed"))
    text = "\n".join(landed_rows(tmp_path / "landed", "A"))
    assert '"a\nb",' in text
    assert landed_rows(tmp_path / "landed", "B") == raw_rows(delivery, "B")
