"""Hand-made patient rows."""

from cohortline.plans import patients as P


def row(i=0, **changes):
    values = {}
    for c in P.SOURCE_COLUMNS:
        if c in P.WHOLE_COLUMNS:
            values[c] = (i * 7 + len(c)) % 2
        elif c not in P.TEXT_COLUMNS:
            values[c] = float((i * 13 + len(c) * 5) % 97) + 1.0
    values.update(patient_id=i % 600, age=20 + i % 60, gender="Male", diagnosis="Normal", anti_t_tg=0, progesterone_antibodies=0)
    values.update(changes)
    return values


def frame(spark, rows):
    return spark.createDataFrame([[r[c] for c in P.SOURCE_COLUMNS] for r in rows], P.source_schema())
