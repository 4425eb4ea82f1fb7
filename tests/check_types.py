"""Report Spark vs DuckDB column types for every registered query (sf0.001)."""
import sys
sys.path.insert(0, ".")
from goldvein.session import build_session  # noqa: E402
from tests.oracle_compare import duck  # noqa: E402
import __spark_entry__ as E  # noqa: E402

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = build_session("local[4]", 4)
con = duck(sf)
bad = 0
for name, fn in E.queries().items():
    s = {f.name: f.dataType.simpleString() for f in fn(spark, sf).schema.fields}
    rel = con.execute(E.oracle_sql()[name])
    o = {d[0]: str(d[1]) for d in rel.description}
    for c, t in s.items():
        if SPARK_TO_DUCK.get(t, t) != o.get(c):
            bad += 1
            print(f"{name}.{c}: spark={t} duck={o.get(c)}")
print("type mismatches:", bad)
