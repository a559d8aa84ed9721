from tidemark.operators.route import TAG_DEAD, TAG_OBJECT, extract_object_path, route_by_folder
from tidemark.specs import default_registry

SCHEMA = "message_id string, attributes map<string,string>"


def test_extract_object_path(spark):
    msgs = [
        ("1", {"eventType": "OBJECT_FINALIZE", "objectId": "Order_Events/a.json.gz", "bucketId": "b"}),
        ("2", {"eventType": "OBJECT_DELETE", "objectId": "Order_Events/a.json.gz", "bucketId": "b"}),
        ("3", {"eventType": "OBJECT_FINALIZE", "objectId": "Order_Events/x.csv", "bucketId": "b"}),
        ("4", {"eventType": "OBJECT_FINALIZE", "objectId": "Order_Events/c.json.gz"}),
        ("5", {"eventType": "OBJECT_FINALIZE", "objectId": "Order_Events/d.json.gz", "bucketId": ""}),
        ("6", {"objectId": "Order_Events/e.json.gz", "bucketId": "b"}),
        ("7", None),
    ]
    out = {r["message_id"]: r for r in extract_object_path(spark.createDataFrame(msgs, SCHEMA)).collect()}
    assert set(out) == {"1", "4", "5"}
    assert out["1"]["tag"] == TAG_OBJECT and out["1"]["source_file"] == "gs://b/Order_Events/a.json.gz"
    for k in ("4", "5"):
        assert out[k]["tag"] == TAG_DEAD and out[k]["table"] == "unknown"
        assert out[k]["source_file"] == "unknown"
        assert out[k]["error"].startswith("PubSub parse failure: Missing bucketId")


def test_route_by_folder(spark):
    df = spark.createDataFrame([("Order_Events/a.json.gz",), ("Other/b.json.gz",),
                                ("Notification_Events/c.json.gz",)], "name string")
    out = {r["name"]: r for r in route_by_folder(df, default_registry()).collect()}
    assert out["Order_Events/a.json.gz"]["table"] == "STG_Order_Events"
    assert out["Notification_Events/c.json.gz"]["tag"] == "Notification_Events"
    assert out["Other/b.json.gz"]["tag"] == TAG_DEAD
    assert out["Other/b.json.gz"]["error"] == "Unrecognised folder: Other"
