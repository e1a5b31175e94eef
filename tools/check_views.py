"""Dev check: Spark bronze views equal the DuckDB mirror."""
import sys, json
sys.path.insert(0, ".")
from hostelry.session import build_session
from hostelry.sources import driver_views as dv
from sqloracle import views as ov
from sqloracle.compare import duck, compare

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = build_session()
con = duck(sf)
for name, fn in dv.VIEWS.items():
    res = compare(fn(spark, sf), con, ov.with_views(f"SELECT * FROM {name}"))
    print(name, json.dumps(res, default=str)[:600])
