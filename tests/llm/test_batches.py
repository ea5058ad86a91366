"""Arrow batch size."""

from genoframe.llm.batches import BATCH_BYTES, SETTING, small_batches


def test_only_a_session_that_has_not_chosen_is_changed(spark):
    other = spark.newSession()
    small_batches(other)
    assert other.conf.get(SETTING) == BATCH_BYTES
    other.conf.set(SETTING, "1m")
    small_batches(other)
    assert other.conf.get(SETTING) == "1m"
