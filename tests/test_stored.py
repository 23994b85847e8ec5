"""The data source over stored files: which files are opened, and what comes out."""

import json

import pytest

from placeloom.sources import stored


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("stored")
    elements = lambda k: [
        {"type": "node", "id": 10 * k, "lat": 51.0 + k, "lon": 0.5, "tags": {"name": f"Kite {k}", "level": 2}},
        {"type": "way", "id": 10 * k + 1, "center": {"lat": 51.5 + k, "lon": 1}, "tags": {"amenity": "cafe"}},
        {"type": "node", "id": 10 * k + 2},
    ]
    for k, unit in enumerate(("Alder", "Birch Hill", "Cedar")):
        (path / f"{unit.replace(' ', '_')}.json").write_text(json.dumps(elements(k)))
    (path / "Broken.json").write_text("{")
    (path / "notes.txt").write_text("no unit")
    return str(path)


def test_only_the_files_of_asked_units_are_opened(spark, folder):
    one = stored.read_stored(spark, folder, units=["Birch Hill"])
    assert one.rdd.getNumPartitions() == 1
    got = [tuple(r) for r in one.orderBy("pos").collect()]
    assert got == [("Birch Hill", 0, "node", 10, 52.0, 0.5, {"name": "Kite 1", "level": "2"}), ("Birch Hill", 1, "way", 11, 52.5, 1.0, {"amenity": "cafe"}), ("Birch Hill", 2, "node", 12, None, None, {})]
    two = stored.read_stored(spark, folder, units=["Alder", "Cedar", "Nowhere"])
    assert two.rdd.getNumPartitions() == 2 and two.count() == 6 and two.where("unit = 'Cedar'").count() == 3 and two.count() == 6
    assert stored.read_stored(spark, folder, units=["Nowhere"]).count() == 0
    with pytest.raises(Exception, match="JSON|Expecting"):
        stored.read_stored(spark, folder).collect()


def test_types_and_boxes_leave_elements_out(spark, folder):
    units = ["Alder", "Birch Hill", "Cedar"]
    assert sorted(r.id for r in stored.read_stored(spark, folder, units=units, type_="way").collect()) == [1, 11, 21]
    near = stored.read_stored(spark, folder, units=units, box=[51.5, 0.5, 52.5, 1])
    assert sorted(r.id for r in near.collect()) == [1, 10, 11]


def test_register_files(spark, tmp_path):
    (tmp_path / "City_of_London.json").write_text(json.dumps({"establishments": [{"FHRSID": 7, "BusinessName": "Ox", "BusinessTypeID": 1, "PostCode": "E1 1AA", "geocode": {"latitude": "51.5", "longitude": "-0.1"}}, {"FHRSID": 8, "geocode": None}]}))
    rows = stored.read_stored(spark, str(tmp_path), "register").orderBy("pos").collect()
    assert [(r.unit, r.FHRSID, r.BusinessName, r.PostCode, r.latitude, r.longitude) for r in rows] == [("City of London", 7, "Ox", "E1 1AA", "51.5", "-0.1"), ("City of London", 8, None, None, None, None)]
