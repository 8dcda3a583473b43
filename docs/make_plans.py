"""Write docs/PLANS.md: physical plans of the build() path over stored tables.

Usage: python docs/make_plans.py /root/testdata/sf0.01
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.operators import quality as Q  # noqa: E402
from tarmac.plans import models as M  # noqa: E402
from tarmac.plans import rule_suites as R  # noqa: E402
from tarmac.session import get_spark, scratch_path  # noqa: E402
from tarmac.sources.fixture import fixture_raw  # noqa: E402


def main(sf_dir: str) -> None:
    spark = get_spark("local[8]", 16)
    base = scratch_path(spark, "plans")
    fixture_raw(spark, sf_dir).write.parquet(f"{base}/raw")
    raw = spark.read.parquet(f"{base}/raw")
    stg = M.stg_flights(raw)
    for name, df in {"fact": M.fact_flights(stg), "car": M.dim_carrier(stg), "air": M.dim_airport(stg)}.items():
        df.write.parquet(f"{base}/{name}")
    fact, car, air = (spark.read.parquet(f"{base}/{n}") for n in ("fact", "car", "air"))
    dat = M.dim_date(fact)
    steps = {
        "fact_flights (from raw)": M.fact_flights(stg),
        "dim_carrier (from raw)": M.dim_carrier(stg),
        "dim_airport (from raw)": M.dim_airport(stg),
        "dim_date (from stored fact)": dat,
        "both marts: carrier_month_stats (stored fact + dims)": M.carrier_month_stats(fact, car, dat),
        "17 declared rules (staging)": Q.check_rows(stg, "stg_flights", R.stg_declared_rules()),
        "relationships (stored fact)": Q.check_relationships(
            fact, "fact_flights", R.fact_relationship_rules(car, air, dat)),
        "unique flight_key, hashed (stored fact)": Q.check_unique(fact, "fact_flights", "flight_key"),
    }
    out = ["# Physical plans of the build() path", "",
           f"Generated by `docs/make_plans.py` over `{os.path.basename(sf_dir)}`; raw stored as parquet.",
           "Scan lines are shortened to the pushed filters and read schema.", ""]
    for title, df in steps.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = []
        for line in plan.split("\n"):
            if "FileScan parquet" in line:
                head = line[:line.index("FileScan parquet") + len("FileScan parquet")]
                pushed = line[line.find("PushedFilters:"):].split(", ReadSchema")[0] if "PushedFilters:" in line else ""
                schema = line[line.find("ReadSchema:"):] if "ReadSchema:" in line else ""
                line = f"{head} {pushed} {schema}"
            lines.append(line[:260])
        out += [f"## {title}", "", "```", *lines, "```", ""]
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
