import json

import pytest
from pyspark.sql import types as T

from appendlake.config import DECIMAL_TRAIT, SYNC_STATE_KEY
from appendlake.sources import manifest


def shaped(**arguments):
    return [
        {"traitReference": "is.other", "arguments": [{"name": "precision", "value": 1}]},
        {
            "traitReference": DECIMAL_TRAIT,
            "arguments": [{"name": k, "value": v} for k, v in arguments.items()],
        },
    ]


DOCUMENT = {
    "name": "export",
    "entities": [
        {
            "name": "account",
            "annotations": [
                {"name": SYNC_STATE_KEY, "value": "InProgress"},
                {"name": SYNC_STATE_KEY, "value": "Completed"},
                {"name": "other", "value": "x"},
            ],
            "attributes": [
                {"name": "Id", "dataType": "guid"},
                {"name": "created", "dataType": "dateTime"},
                {"name": "modified", "dataType": "dateTimeOffset"},
                {"name": "version", "dataType": "int64"},
                {"name": "revenue", "dataType": "decimal", "cdm:traits": shaped(precision=38, scale=2)},
                {"name": "whole", "dataType": "decimal", "cdm:traits": shaped(precision=38, scale=0)},
                {"name": "texts", "dataType": "decimal", "cdm:traits": shaped(precision="20", scale="4")},
                {"name": "half", "dataType": "decimal", "cdm:traits": shaped(precision=38)},
                {"name": "plain", "dataType": "decimal"},
                {"name": "score", "dataType": "double", "cdm:traits": shaped(precision=5, scale=2)},
                {"name": "active", "dataType": "boolean"},
                {"name": "odd", "dataType": "picture"},
                {"name": "name", "dataType": "string"},
            ],
        },
        {"name": "empty", "annotations": [{"name": SYNC_STATE_KEY, "value": "Completed"}], "attributes": []},
        {"name": "busy", "annotations": [{"name": SYNC_STATE_KEY, "value": "InProgress"}]},
        {"name": "bare"},
    ],
}


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "model.json"
    file.write_text(json.dumps(DOCUMENT, indent=2))
    return str(file)


def test_schemas(spark, path):
    found = manifest.schemas(manifest.read_entities(spark, path))
    assert list(found) == ["account", "empty"]
    assert found["empty"] == T.StructType([])
    assert found["account"].simpleString() == (
        "struct<Id:string,created:timestamp,modified:timestamp,version:bigint,revenue:decimal(38,2),"
        "whole:decimal(38,0),texts:decimal(20,4),half:decimal(10,0),plain:decimal(10,0),score:double,"
        "active:boolean,odd:string,name:string>"
    )


def test_selection_state_and_warnings(spark, path):
    assert [r.entity for r in manifest.read_entities(spark, path, ["empty", "busy"]).collect()] == ["empty"]
    account = manifest.read_entities(spark, path, ["account"])
    row = account.first()
    assert row.sync_state == "Completed"
    assert row.annotations == {SYNC_STATE_KEY: "Completed", "other": "x"}
    assert [tuple(r) for r in manifest.warnings(account).collect()] == [("account", "odd", "picture")]
