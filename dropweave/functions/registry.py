"""Record types: the declared layout of every kind of line in a drop.

Nothing is inferred from data.  A registry is plain driver-side metadata (a dozen
small entries); the schemas it hands out go to Spark's own CSV functions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import types as T

# Type words accepted in a layout.  TIME stays text when scanned: a bare clock time
# read as a timestamp would take on the date of the day the job runs.
_SPARK_TYPES = {
    "string": T.StringType, "integer": T.IntegerType, "int": T.IntegerType,
    "long": T.LongType, "bigint": T.LongType, "number": T.DoubleType,
    "double": T.DoubleType, "date": T.DateType, "time": T.StringType,
}

# Id, name, primary key and layout of the twelve standard record types.
# The order of the fields is their position in the line.
_STANDARD_LAYOUTS = (
    ("10", "Header", "", """
        RECORD_IDENTIFIER INT, CUSTODIAN_NAME STRING, LOCAL_CUSTODIAN_CODE INT, PROCESS_DATE DATE,
        VOLUME_NUMBER INT, ENTRY_DATE DATE, TIME_STAMP TIME, VERSION STRING, FILE_TYPE STRING
    """),
    ("11", "Street", "USRN", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, USRN BIGINT, RECORD_TYPE STRING,
        SWA_ORG_REF_NAMING INT, STATE STRING, STATE_DATE DATE, STREET_SURFACE STRING,
        STREET_CLASSIFICATION STRING, VERSION INT, STREET_START_DATE DATE, STREET_END_DATE DATE,
        LAST_UPDATE_DATE DATE, RECORD_ENTRY_DATE DATE, STREET_START_X DOUBLE, STREET_START_Y DOUBLE,
        STREET_START_LAT DOUBLE, STREET_START_LONG DOUBLE, STREET_END_X DOUBLE, STREET_END_Y DOUBLE,
        STREET_END_LAT DOUBLE, STREET_END_LONG DOUBLE, STREET_TOLERANCE INT
    """),
    ("15", "StreetDescriptor", "USRN", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, USRN BIGINT,
        STREET_DESCRIPTION STRING, LOCALITY STRING, TOWN_NAME STRING, ADMINISTRATIVE_AREA STRING,
        LANGUAGE STRING, START_DATE DATE, END_DATE DATE, LAST_UPDATE_DATE DATE, ENTRY_DATE DATE
    """),
    ("21", "BPLU", "UPRN", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, LOGICAL_STATUS STRING,
        BLPU_STATE STRING, BLPU_STATE_DATE DATE, PARENT_UPRN BIGINT, X_COORDINATE DOUBLE,
        Y_COORDINATE DOUBLE, LATITUDE DOUBLE, LONGITUDE DOUBLE, RPC STRING, LOCAL_CUSTODIAN_CODE INT,
        COUNTRY STRING, START_DATE DATE, END_DATE DATE, LAST_UPDATE_DATE DATE, ENTRY_DATE DATE,
        ADDRESSBASE_POSTAL STRING, POSTCODE_LOCATOR STRING, MULTI_OCC_COUNT INT
    """),
    ("23", "ApplicationCrossReference", "", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, XREF_KEY STRING,
        CROSS_REFERENCE STRING, VERSION INT, SOURCE STRING, START_DATE DATE, END_DATE DATE,
        LAST_UPDATE_DATE DATE, ENTRY_DATE DATE
    """),
    ("24", "LPI", "", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, LPI_KEY STRING,
        LANGUAGE STRING, LOGICAL_STATUS STRING, START_DATE DATE, END_DATE DATE, LAST_UPDATE_DATE DATE,
        ENTRY_DATE DATE, SAO_START_NUMBER INT, SAO_START_SUFFIX STRING, SAO_END_NUMBER INT,
        SAO_END_SUFFIX STRING, SAO_TEXT STRING, PAO_START_NUMBER INT, PAO_START_SUFFIX STRING,
        PAO_END_NUMBER INT, PAO_END_SUFFIX STRING, PAO_TEXT STRING, USRN BIGINT,
        USRN_MATCH_INDICATOR STRING, AREA_NAME STRING, LEVEL STRING, OFFICIAL_FLAG STRING
    """),
    ("28", "DeliveryPointAddress", "", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, UDPRN INT,
        ORGANISATION_NAME STRING, DEPARTMENT_NAME STRING, SUB_BUILDING_NAME STRING,
        BUILDING_NAME STRING, BUILDING_NUMBER INT, DEPENDENT_THOROUGHFARE STRING, THOROUGHFARE STRING,
        DOUBLE_DEPENDENT_LOCALITY STRING, DEPENDENT_LOCALITY STRING, POST_TOWN STRING, POSTCODE STRING,
        POSTCODE_TYPE STRING, DELIVERY_POINT_SUFFIX STRING, WELSH_DEPENDENT_THOROUGHFARE STRING,
        WELSH_THOROUGHFARE STRING, WELSH_DOUBLE_DEPENDENT_LOCALITY STRING,
        WELSH_DEPENDENT_LOCALITY STRING, WELSH_POST_TOWN STRING, PO_BOX_NUMBER STRING,
        PROCESS_DATE DATE, START_DATE DATE, END_DATE DATE, LAST_UPDATE_DATE DATE, ENTRY_DATE DATE
    """),
    ("29", "Metadata", "", """
        RECORD_IDENTIFIER INT, GAZ_NAME STRING, GAZ_SCOPE STRING, TER_OF_USE STRING,
        LINKED_DATA STRING, GAZ_OWNER STRING, NGAZ_FREQ STRING, CUSTODIAN_NAME STRING,
        CUSTODIAN_UPRN BIGINT, LOCAL_CUSTODIAN_CODE INT, CO_ORD_SYSTEM STRING, CO_ORD_UNIT STRING,
        META_DATE DATE, CLASS_SCHEME STRING, GAZ_DATE DATE, LANGUAGE STRING, CHARACTER_SET STRING
    """),
    ("30", "SuccessorRecord", "", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, SUCC_KEY STRING,
        START_DATE DATE, END_DATE DATE, LAST_UPDATE_DATE DATE, ENTRY_DATE DATE, SUCCESSOR INT
    """),
    ("31", "Organisation", "ORG_KEY", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, ORG_KEY STRING,
        ORGANISATION STRING, LEGAL_NAME STRING, START_DATE DATE, END_DATE DATE, LAST_UPDATE_DATE DATE,
        ENTRY_DATE DATE
    """),
    ("32", "Classification", "CLASS_KEY", """
        RECORD_IDENTIFIER INT, CHANGE_TYPE STRING, PRO_ORDER INT, UPRN BIGINT, CLASS_KEY STRING,
        CLASSIFICATION_CODE STRING, CLASS_SCHEME STRING, SCHEME_VERSION DOUBLE, START_DATE DATE,
        END_DATE DATE, LAST_UPDATE_DATE DATE, ENTRY_DATE DATE
    """),
    ("99", "Trailer", "", """
        RECORD_IDENTIFIER INT, NEXT_VOLUME_NUMBER INT, RECORD_COUNT INT, ENTRY_DATE DATE,
        TIME_STAMP TIME
    """),
)

# Roles of the record types.
CONTROL_IDS = ("10", "29", "99")
LOCATION_IDS = ("11", "15", "21", "24", "28", "31", "32")
UPRN_PARENT, UPRN_CHILDREN = "21", ("24", "28", "31", "32")
USRN_PARENT, USRN_CHILDREN = "11", ("15",)
KEY_POSITION = 3
UPRN_CHUNK, USRN_CHUNK = 100_000, 50_000


@dataclass(frozen=True)
class RecordType:
    id: str
    name: str
    primary_key: str
    fields: tuple[tuple[str, str], ...]

    def __post_init__(self):
        unknown = sorted({kind for _, kind in self.fields if kind.lower() not in _SPARK_TYPES})
        if unknown:
            raise ValueError(f"record type {self.id}: unknown field type(s) {unknown}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, _SPARK_TYPES[kind.lower()](), True) for name, kind in self.fields])

    @property
    def field_names(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def key_field(self) -> str | None:
        """The grouping key: the field at position 3 when it is a long integer."""
        if len(self.fields) <= KEY_POSITION:
            return None
        name, kind = self.fields[KEY_POSITION]
        return name if kind.lower() in ("long", "bigint") else None

    @classmethod
    def from_layout(cls, id: str, name: str, layout: str, primary_key: str = "") -> RecordType:
        """``layout`` is a comma list of ``NAME TYPE`` pairs in line order."""
        fields = tuple(tuple(part.split()) for part in layout.split(","))
        return cls(str(id), name, primary_key, fields)


class Registry:
    """Record types by id."""

    def __init__(self, types: Iterable[RecordType]):
        self._types = {t.id: t for t in types}

    def __getitem__(self, record_id: str) -> RecordType:
        try:
            return self._types[str(record_id)]
        except KeyError:
            raise KeyError(f"unknown record type {record_id!r}; known: {', '.join(self._types)}") from None

    def __iter__(self) -> Iterator[RecordType]:
        return iter(self._types.values())

    def __contains__(self, record_id: str) -> bool:
        return str(record_id) in self._types

    @property
    def ids(self) -> list[str]:
        return list(self._types)

    @classmethod
    def standard(cls) -> Registry:
        return cls(RecordType.from_layout(i, n, layout, p) for i, n, p, layout in _STANDARD_LAYOUTS)

    @classmethod
    def from_dict(cls, entries: dict) -> Registry:
        """Entries keyed by id, each ``{name, schema: {primaryKey, fields: [{name, type}]}}``."""
        return cls(
            RecordType(str(record_id), entry["name"], entry["schema"].get("primaryKey") or "",
                       tuple((f["name"], f["type"]) for f in entry["schema"]["fields"]))
            for record_id, entry in entries.items())

    @classmethod
    def from_yaml(cls, path: str) -> Registry:
        try:
            import yaml
        except ImportError as exc:  # the parser is optional: from_dict takes any mapping
            raise RuntimeError("reading a YAML registry needs PyYAML") from exc
        with open(path, encoding="utf-8") as handle:
            return cls.from_dict(yaml.safe_load(handle))
