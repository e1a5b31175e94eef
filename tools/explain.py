"""Print the formatted physical plan of a registered query.

    python tools/explain.py kpi_revpar [/root/testdata/sf0.01] [--large]

``--large`` disables size-based broadcasts so the plan is the one large
inputs would get (explicit, size-checked broadcasts remain).
"""
import sys

sys.path.insert(0, ".")
from hostelry.plans.queries import QUERIES  # noqa: E402
from hostelry.session import build_session  # noqa: E402

args = [a for a in sys.argv[1:] if not a.startswith("--")]
name, sf = args[0], (args[1] if len(args) > 1 else "/root/testdata/sf0.01")
spark = build_session()
if "--large" in sys.argv:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
QUERIES[name](spark, sf).explain("formatted")
