from trailframe.operators import sequences


def test_windows(track):
    out = sequences.sequence_windows(track([(1, i, 44 + i, 12) for i in range(5)] + [(2, 0, 44, 12)]), ["rental_id"], ["latitude"], 2)
    got = {(r["rental_id"], r["window"]): [p[0] for p in r["values"]] for r in out.collect()}
    assert got == {(1, 0): [44, 45], (1, 1): [45, 46], (1, 2): [46, 47], (1, 3): [47, 48], (2, 0): [44]}


def test_long_trajectories_are_windowed_whole(track, hot):
    """Beyond the former limit of 256 positions, and with a hot key."""
    out = sequences.sequence_windows(track([(1, i, 44 + i / 1000, 12) for i in range(700)]), ["rental_id"], ["latitude"], 10)
    rows = out.collect()
    assert sorted(r["window"] for r in rows) == list(range(691)) and all(len(r["values"]) == 10 for r in rows)


def test_labels_come_back_to_positions(track, spark):
    df = track([(1, i, 44, 12) for i in range(300)] + [(2, 0, 44, 12)])
    labels = spark.createDataFrame([(1, 5)], "rental_id long, cluster_id long")
    out = sequences.label_positions(df, labels, ["rental_id"], renumber=False)
    assert out.count() == 300 and out.select("cluster_id").distinct().collect() == [(5,)]
