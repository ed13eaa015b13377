from medalla.config import PipelineConfig, normalise_path


def test_normalise_path_keeps_scheme_and_drops_double_slashes():
    assert normalise_path("/vol/input//ventas/") == "/vol/input/ventas"
    assert normalise_path("s3a://bucket//landing/") == "s3a://bucket/landing"
    assert normalise_path("/") == "/"


def test_config_from_session_keys(spark):
    keys = {
        "medalla.warehouse": "/data/wh/",
        "medalla.landing": "/data//landing",
        "medalla.history_buckets": "128",
        "medalla.dedup_first": "true",
        "medalla.jdbc.url": "jdbc:derby:memory:x",
        "medalla.jdbc.dbtable": "TRACKING",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        cfg = PipelineConfig.from_spark(spark)
        assert cfg.warehouse == "/data/wh" and cfg.landing == "/data/landing"
        assert cfg.history_buckets == 128 and cfg.dedup_first and not cfg.full_refresh
        assert dict(cfg.jdbc_options) == {"url": "jdbc:derby:memory:x", "dbtable": "TRACKING"}
        assert cfg.table_path("gold", "x") == "/data/wh/g0/gold/x"
        assert cfg.table_path("bronze", "sales") == "/data/wh/bronze/sales"
        assert cfg.checkpoints.startswith(normalise_path(spark.conf.get("spark.checkpoint.dir")))
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_apply_defaults_respects_explicit_settings(spark):
    from medalla.session import RUNTIME_DEFAULTS, apply_defaults

    applied = apply_defaults(spark)
    # local_session set these explicitly: they must not be overridden
    assert "spark.sql.adaptive.enabled" not in applied
    assert "spark.sql.streaming.stateStore.providerClass" not in applied
    for key, value in RUNTIME_DEFAULTS.items():
        assert spark.conf.get(key) == (value if key in applied else spark.conf.get(key))
    assert apply_defaults(spark) == {}  # idempotent
