from quillspark.plans.data_queries import QUERIES


def test_item_and_child_tables_are_linked(spark, tmp_path):
    body = '{"results": [null, {"title": "A work", "authorships": [{"author": {"display_name": " "}}, {"author": {"display_name": "Ada"}}]}]}'
    spark.createDataFrame([(7, body)], "payload_id bigint, body string").write.parquet(f"{tmp_path}/payloads.parquet")
    items, children = QUERIES["p2_items"](spark, str(tmp_path)), QUERIES["p2_children"](spark, str(tmp_path))
    got = items.join(children.withColumnsRenamed({"field": "child", "value": "name"}), ["payload_id", "item_pos"])
    assert [tuple(r) for r in got.select("payload_id", "item_pos", "value", "child", "child_pos", "name").collect()] == [(7, 1, "A work", "author", 1, "Ada")]
