from ledgerlake import config as C


def wide_train(spark, annual_inc_null: bool):
    cols = list(C.SKEWED_AMOUNT) + list(C.NUMERIC) + list(C.NUMERIC_WITH_INDICATOR) + list(C.NOMINAL) + list(C.STRUCTURAL_MISSING)
    rows = []
    for i in range(10):
        r = []
        for c in cols:
            if c in C.STRUCTURAL_MISSING:
                r.append(None)  # 100% missing but exempt
            elif c == "annual_inc" and annual_inc_null and i < 6:
                r.append(None)
            elif c in C.NOMINAL:
                r.append("x")
            else:
                r.append(1.0)
        rows.append(tuple(r))
    schema = ", ".join(f"{c} {'string' if c in C.NOMINAL else 'double'}" for c in cols)
    return spark.createDataFrame(rows, schema)
