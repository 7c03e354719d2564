import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dropweave.functions.registry import RecordType, Registry  # noqa: E402
from dropweave.plans import jobs  # noqa: E402
from dropweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8",
                            spark__ui__enabled="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    """Short layouts for the types the grouping steps use."""
    keyed = "RECORD_IDENTIFIER integer, CHANGE_TYPE string, PRO_ORDER integer, {} long, TEXT string"
    return Registry([
        RecordType.from_layout("10", "Header", "RECORD_IDENTIFIER integer, FILE_NAME string"),
        RecordType.from_layout("29", "Metadata", "RECORD_IDENTIFIER integer, SCOPE string"),
        RecordType.from_layout("99", "Trailer", "RECORD_IDENTIFIER integer, RECORD_COUNT integer"),
        *(RecordType.from_layout(i, n, keyed.format("USRN")) for i, n in (("11", "Street"), ("15", "StreetDescriptor"))),
        *(RecordType.from_layout(i, n, keyed.format("UPRN")) for i, n in (
            ("21", "BPLU"), ("24", "LPI"), ("28", "DeliveryPointAddress"), ("31", "Organisation"),
            ("32", "Classification"))),
    ])


@pytest.fixture
def drop(spark, small, tmp_path):
    """Write drop files and return them landed and numbered."""
    def make(*files, scan_mode="line", registry=None, sep="\n"):
        folder = tmp_path / "drop"
        folder.mkdir(exist_ok=True)
        for number, lines in enumerate(files):
            (folder / f"f{number}.csv").write_bytes("".join(line + sep for line in lines).encode())
        return jobs.prepare(spark, str(folder), registry or small, scan_mode=scan_mode)
    return make


def row(record_id, key, text="", serial=1):
    return f'{record_id},"I",{serial},{key},{text}'


def ordered(grouped):
    """(record_type, key, text) in group order."""
    rows = grouped.orderBy("key", "type_rank", "source_file", "line_no").collect()
    return [(r.record_type, r.key, r.value.rsplit(",", 1)[1]) for r in rows]
