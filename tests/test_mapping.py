import datetime as dt
import json

import pytest

from feedhouse.fixed import DEFAULT_MAPPING
from feedhouse.functions.nested import record_json
from feedhouse.operators.mapping import PythonTransform, load_config, map_rows

AT = dt.datetime(2024, 5, 6, 7, 8, 9, 123000)


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [(2, " Acme ", "A@B.co", "555.0200 x1", " de "), (3, None, "", "7", "x")],
        "_rowNumber bigint, company_name string, contact_email string, phone_number string, country string",
    )


def test_default_mapping(rows):
    first = map_rows(rows, run_at=AT).customers.orderBy("_rowNumber").first()
    assert (first.name, first.email, first.taxId, first.contact.phone, first.address.country) == (
        "Acme", "a@b.co", "", "5550200 1", "DE",
    )
    assert first.metadata.asDict() == {"source": "csv_import", "importedAt": "2024-05-06T07:08:09.123Z"}


def test_json_keeps_null_fields(rows):
    customers = map_rows(rows, run_at=AT).customers
    payload = json.loads(customers.select(record_json(["name", "contact"])).first()[0])
    assert payload == {"name": "Acme", "contact": {"firstName": "", "lastName": "", "phone": "5550200 1"}}


def test_only_configured_transforms_apply(rows):
    config = {"fieldMappings": {"name": {"from": "company_name", "transform": "trim"}}, "transforms": {}}
    assert map_rows(rows, config).customers.orderBy("_rowNumber").first().name == " Acme "


def test_expression_and_bad_expression(rows):
    config = {
        "fieldMappings": {
            "a": {"from": "country", "transform": "twice"}, "b": {"from": "country", "transform": "script"},
            "c": {"from": "phone_number", "transform": "number"},
        },
        "transforms": {
            "twice": "concat(trim(value), value)", "script": "value => value.trim()",
            "number": "cast(value as int) + 1",
        },
    }
    with pytest.warns(UserWarning, match="script"):
        mapped = map_rows(rows, config)
    found = mapped.customers.orderBy("_rowNumber").collect()
    assert [(r.a, r.b, r.c) for r in found] == [("de de ", " de ", "555.0200 x1"), ("xx", "x", "8")]
    assert [(r._rowNumber, r.error) for r in mapped.errors.collect()] == [
        (2, "cast(value as int) + 1 failed for: 555.0200 x1")]


def test_null_of_an_expression_is_kept(rows):
    config = {
        "fieldMappings": {"a": {"from": "country", "transform": "none"}, "b": {"from": "phone_number", "transform": "number"},
                          "c": {"from": "phone_number", "transform": "split"}},
        "transforms": {"none": "nullif(value, 'x')", "number": "try_cast(value as int) + 1",
                       "split": "element_at(split(value, ' '), 2)"},
    }
    mapped = map_rows(rows, config)
    found = mapped.customers.orderBy("_rowNumber").collect()
    assert [(r.a, r.b, r.c) for r in found] == [(" de ", None, "x1"), (None, "8", "7")]
    assert [r._rowNumber for r in mapped.errors.collect()] == [3]
    rejected = map_rows(rows, config, on_error="reject").customers.collect()
    assert [r._rowNumber for r in rejected] == [2]


@pytest.mark.parametrize("on_error, kept", [("raw", [2, 3]), ("reject", [3])])
def test_python_transform_errors(rows, on_error, kept):
    def whole(value):
        return str(int(value) * 2)

    config = {
        "fieldMappings": {"n": {"from": "phone_number", "transform": "whole"}},
        "nestedMappings": {"more": {"n": {"from": "phone_number", "transform": "whole"}}},
        "transforms": {"whole": PythonTransform(whole)},
    }
    mapped = map_rows(rows, config, on_error=on_error)
    found = mapped.customers.orderBy("_rowNumber").collect()
    assert [r._rowNumber for r in found] == kept
    assert found[-1].n == "14" and found[-1].more.n == "14"
    errors = mapped.errors.collect()
    assert [r._rowNumber for r in errors] == [2] and "invalid literal" in errors[0].error


def test_config_file(tmp_path):
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps({"fieldMappings": {}}))
    assert load_config(str(path)) == {"fieldMappings": {}}
    assert load_config() is DEFAULT_MAPPING
