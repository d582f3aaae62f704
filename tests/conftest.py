import datetime as dt
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tableflow.session import local_session  # noqa: E402
from tableflow.specs import JobContext  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tableflow-tests", cores="4", memory="4g",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))},
    )
    yield session
    session.stop()


@pytest.fixture
def ctx():
    return JobContext("shop", dt.date(2021, 6, 21))


# Sample deliveries; header, comma, narrower than the schemas.
SAMPLES = {
    "items": "itemId,name,price\n1,bucket,5\n2,cup,1\n3,t-shirt,2\n",
    "orders": "orderId,customerId,itemId,quantity\n1,1,1,1\n2,2,2,3\n3,2,2,5\n",
    "customers": "customerId,name,country\n1,Alex,Ukraine\n2,Arseniy,Russia\n3,Oleg,Belarus\n",
}

# The fields of the schema files.
_DATED = [("year", "integer"), ("month", "integer"), ("day", "integer")]
_STAMPED = [
    *_DATED, ("last_update_time", "long"), ("execution_year", "integer"),
    ("execution_month", "integer"), ("execution_day", "integer"),
]
FIELDS = {
    "items": [("itemId", "integer"), ("name", "string"), ("price", "double"), *_STAMPED],
    "orders": [
        ("orderId", "integer"), ("customerId", "integer"), ("itemId", "integer"),
        ("quantity", "integer"), *_STAMPED,
    ],
    "customers": [
        ("customerId", "integer"), ("name", "string"), ("country", "string"), *_DATED,
    ],
}


@pytest.fixture
def delivery(tmp_path, ctx):
    """Sample files and schema files as they are delivered for one day."""
    day = Path(ctx.dated_dir(str(tmp_path / "in")))
    day.mkdir(parents=True)
    for name, text in SAMPLES.items():
        (day / f"{name}_{ctx.execution_date}.csv").write_text(text)
    schemas = tmp_path / "schema"
    schemas.mkdir()
    for name, fields in FIELDS.items():
        (schemas / f"{name}.json").write_text(json.dumps({
            "type": "struct",
            "fields": [
                {"name": n, "type": t, "nullable": n not in dict(_STAMPED), "metadata": {}}
                for n, t in fields
            ],
        }))
    return tmp_path


def rows(df, *columns):
    """Sorted row tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
