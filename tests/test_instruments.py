"""The register's full and delta files, hand-written."""

import pytest

from sparkbook.sources import instruments as I
from sparkbook.sources import registers as R


def record(isin, mic, extra="", cfi="ESVUFR", ccy="EUR"):
    return (f"<FinInstrmGnlAttrbts><Id>{isin}</Id><FullNm>Name {isin}</FullNm><ClssfctnTp>{cfi}</ClssfctnTp><NtnlCcy>{ccy}</NtnlCcy></FinInstrmGnlAttrbts>"
            f"<Issr>529900T8BM49AURSDO55</Issr><TradgVnRltdAttrbts><Id>{mic}</Id>{extra}</TradgVnRltdAttrbts>")


OPTION = ("<DerivInstrmAttrbts><XpryDt>2027-01-15</XpryDt><OptnTp>CALL</OptnTp><UndrlygInstrm><Bskt><ISIN>DE0001102333</ISIN><ISIN>US0378331005</ISIN>"
          "<LEI>529900T8BM49AURSDO55</LEI></Bskt></UndrlygInstrm></DerivInstrmAttrbts>")
INDEX = "<DerivInstrmAttrbts><UndrlygInstrm><Sngl><Indx><Nm><RefRate><Nm>EURIBOR</Nm></RefRate></Nm></Indx></Sngl></UndrlygInstrm></DerivInstrmAttrbts>"


def delta_file(tmp_path, name, records, date="2026-07-18"):
    body = "".join(f"<FinInstrm>{r}</FinInstrm>" for r in records)
    text = (f'<?xml version="1.0"?><Doc xmlns="urn:test"><RptHdr><RptgPrd><Dt>{date}</Dt></RptgPrd></RptHdr>'
            f"<FinInstrmRptgRefDataDltaRpt>{body}</FinInstrmRptgRefDataDltaRpt></Doc>")
    path = tmp_path / name
    path.write_text(text)
    return str(path)


GOOD = [
    f"<NewRcrd>{record('DE0001102333', 'XETR')}</NewRcrd>",
    f"<ModfdRcrd>{record('US0378331005', 'XNAS')}{OPTION}</ModfdRcrd>",
    f"<TermntdRcrd>{record('FR0000131104', 'XPAR', '<TermntnDt>2026-07-17</TermntnDt>')}<TechAttrbts><NvrPblshd>true</NvrPblshd></TechAttrbts></TermntdRcrd>",
    "<CancRcrd><FinInstrmGnlAttrbts><Id>GB0002634946</Id></FinInstrmGnlAttrbts><TradgVnRltdAttrbts><Id>XLON</Id></TradgVnRltdAttrbts></CancRcrd>",
]


def test_full_file_has_every_mapped_column(spark, tmp_path):
    path = tmp_path / "FULINS_D_20260718_01of01.xml"
    path.write_text('<?xml version="1.0"?><f:Doc xmlns:f="urn:test">' + "".join(
        f"<f:RefData>{r}</f:RefData>".replace("<", "<f:").replace("<f:/", "</f:").replace("<f:f:", "<f:").replace("</f:f:", "</f:")
        for r in (record("DE0001102333", "XETR"), record("US0378331005", "XNAS") + OPTION, record("FR0000131104", "XPAR") + INDEX)) + "</f:Doc>")
    got = I.read_full(spark, str(path))
    assert len(I.COLUMNS) == 26 and set(I.COLUMNS) <= set(got.columns)
    rows = got.orderBy("record_sequence").collect()
    assert [(r.isin, r.trading_venue_mic, r.cfi_category, r.publication_date, r.record_sequence) for r in rows] == [
        ("DE0001102333", "XETR", "D", "2026-07-18", 1), ("US0378331005", "XNAS", "D", "2026-07-18", 2), ("FR0000131104", "XPAR", "D", "2026-07-18", 3)]
    assert rows[1].option_type == "CALL" and rows[1].derivative_expiry_dt == "2027-01-15" and rows[0].option_type is None
    kids = [tuple(r) for r in I.underlyings(got).select("parent_isin", "underlying_source", "underlying_type", "underlying_id", "underlying_name", "ordinal")
            .orderBy("parent_isin", "ordinal").collect()]
    assert kids == [
        ("FR0000131104", "single", "INDEX", None, "EURIBOR", 1),
        ("US0378331005", "basket", "ISIN", "DE0001102333", None, 1),
        ("US0378331005", "basket", "ISIN", "US0378331005", None, 2),
        ("US0378331005", "basket", "LEI", "529900T8BM49AURSDO55", None, 3),
    ]


def test_delta_records_types_header_and_sequence(spark, tmp_path):
    delta_file(tmp_path, "DLTINS_20260718_01of02.xml", GOOD)
    delta_file(tmp_path, "DLTINS_20260718_02of02.xml", GOOD[:1])
    got = I.read_deltas(spark, str(tmp_path))
    rows = [tuple(r) for r in got.select("source_file", "record_sequence", "record_type", "isin", "cfi_category", "reporting_date", "never_published")
            .orderBy("source_file", "record_sequence").collect()]
    assert rows == [
        ("DLTINS_20260718_01of02.xml", 1, "NEW", "DE0001102333", "E", "2026-07-18", None),
        ("DLTINS_20260718_01of02.xml", 2, "MODFD", "US0378331005", "E", "2026-07-18", None),
        ("DLTINS_20260718_01of02.xml", 3, "TERMNTD", "FR0000131104", "E", "2026-07-18", "true"),
        ("DLTINS_20260718_01of02.xml", 4, "CANC", "GB0002634946", None, "2026-07-18", None),
        ("DLTINS_20260718_02of02.xml", 1, "NEW", "DE0001102333", "E", "2026-07-18", None),
    ]
    kids = I.underlyings(got)
    assert kids.count() == 3 and I.delta_rules(got, kids).count() == 0


@pytest.mark.parametrize(("records", "date", "rule", "severity"), [
    (GOOD, "2026-07-19", "header_date_differs", "fatal"),
    (["<CancRcrd>" + record("DE0001102333", "XETR") + "</CancRcrd>"], "2026-07-18", "canc_with_payload", "fatal"),
    (["<NewRcrd>" + record("", "XETR") + "</NewRcrd>"], "2026-07-18", "missing_key", "fatal"),
    (["<NewRcrd>" + record("DE00", "XETR") + "</NewRcrd>"], "2026-07-18", "bad_isin", "fatal"),
    (["<NewRcrd>" + record("DE0001102333", "xetra") + "</NewRcrd>"], "2026-07-18", "bad_trading_venue_mic", "fatal"),
    (["<NewRcrd>" + record("DE0001102333", "XETR", cfi="") + "</NewRcrd>"], "2026-07-18", "no_cfi_code", "warn"),
    (["<ModfdRcrd>" + record("DE0001102333", "XETR", ccy="") + "</ModfdRcrd>"], "2026-07-18", "no_notional_ccy", "warn"),
    (["<TermntdRcrd>" + record("DE0001102333", "XETR") + "</TermntdRcrd>"], "2026-07-18", "undated_termination", "warn"),
])
def test_each_delta_rule_can_fail(spark, tmp_path, records, date, rule, severity):
    delta_file(tmp_path, "DLTINS_20260718_01of01.xml", records, date)
    got = I.read_deltas(spark, str(tmp_path))
    found = {(r.rule, r.severity) for r in I.delta_rules(got, I.underlyings(got)).collect()}
    assert found == {(rule, severity)}


def test_record_without_one_change_type_fails(spark, tmp_path):
    delta_file(tmp_path, "DLTINS_20260718_01of01.xml", ["<Other><Id>1</Id></Other>"])
    with pytest.raises(Exception, match="without exactly one change type"):
        I.read_deltas(spark, str(tmp_path)).collect()


def test_foreign_file_name_fails(spark, tmp_path):
    delta_file(tmp_path, "NOTES_20260718.xml", GOOD)
    with pytest.raises(Exception, match="unexpected file name"):
        I.read_deltas(spark, str(tmp_path)).collect()


def test_lineage_columns(spark, tmp_path):
    delta_file(tmp_path, "DLTINS_20260718_01of01.xml", GOOD)
    raw = spark.read.text(str(tmp_path))
    out = R.add_lineage(raw, publication_date="2026-07-18", ingested_at="2026-07-19 00:00:00")
    assert {r.source_file for r in out.collect()} == {"DLTINS_20260718_01of01.xml"} and "ingested_at" in out.columns
