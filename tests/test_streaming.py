def test_stream_scores_equal_batch(spark):
    from lexiflow.plans.catalog import q_nb_predict, q_stream_nb_predict
    from tests.conftest import SF001
    streamed = {(r["doc_id"], r["split"], r["prediction"]) for r in q_stream_nb_predict(spark, SF001).collect()}
    batch = {(r["doc_id"], r["split"], r["prediction"]) for r in q_nb_predict(spark, SF001).collect()}
    assert streamed == batch and len(batch) == 40
