import os

from flowsift.storage import materialize, new_path, recorded, remove


def test_recorded_folders_can_be_removed(spark):
    with recorded() as outer:
        kept = materialize(spark.range(3), "kept")
        with recorded() as inner:
            materialize(spark.range(3), "scratch")
            new_path(spark, "unused")
    materialize(spark.range(3), "later")
    assert len(inner) == 2 and len(outer) == 3 and outer[1:] == inner
    remove(spark, inner)
    remove(spark, inner)
    assert not any(map(os.path.exists, inner)) and kept.count() == 3
    remove(spark, outer)
    assert not any(map(os.path.exists, outer))
