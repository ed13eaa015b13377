from pyspark.sql import functions as F

from medalla.functions import labels as L


def _apply(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_standardise_underscore_trim_initcap(spark):
    got = _apply(spark, ["producto_defectuoso", " NO_CUMPLE ", None, "En_camino"], L.standardise)
    assert got == ["Producto Defectuoso", "No Cumple", None, "En Camino"]


def test_trim_keeps_tabs(spark):
    got = _apply(spark, ["\tEFV"], lambda c: L.remap(L.standardise(c), L.PAY_METHOD_MAP))
    assert got == ["\tefv"]


def test_pay_method_map_reaches_underscore_spelling(spark):
    raw = [" EFV", "tarjeta", "TARJETA_CREDITO", "tc ", "transferencia", "efectivo", "Cheque"]
    got = _apply(spark, raw, lambda c: L.remap(L.standardise(c), L.PAY_METHOD_MAP))
    assert got == [
        "Efectivo",
        "Tarjeta De Credito",
        "Tarjeta De Credito",
        "Tarjeta De Credito",
        "Transferencia Bancaria",
        "Efectivo",
        "Cheque",
    ]


def test_category_map(spark):
    raw = ["Climatización", " ELECTRÓNICA", "LINEA_BLANCA", "línea blanca", "muebles", "Electronica"]
    got = _apply(spark, raw, lambda c: L.remap(L.standardise(c), L.CATEGORY_MAP))
    assert got == ["Climatizacion", "Electronica", "Linea Blanca", "Linea Blanca", "Muebles", "Electronica"]


def test_courier_keeps_underscore(spark):
    got = _apply(spark, [" dhl", "olva_courier "], lambda c: L.standardise(c, underscores=False))
    assert got == ["Dhl", "Olva_courier"]
