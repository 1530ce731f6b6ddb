"""Files that were read go to the archive; the landing folder holds new ones only."""

import os

from helpers import series_payload, settings_for, write_json
from ratelake.plans.runner import run, silver_table
from ratelake.sources.landing import files_in


def _names(folder):
    return sorted(f for _, _, fs in os.walk(folder) for f in fs if f.endswith(".json"))


def test_second_run_lists_only_new_files(spark, root):
    st = settings_for(root, archive=f"{root}/archive")
    sel, ipc = series_payload(months=24, days=20)
    write_json(f"{st.landing}/selic.json", sel)
    write_json(f"{st.landing}/ipca.json", ipc)
    first = run(spark, st)
    assert first.passed and first.metrics["bronze"]["landing_files"] == 2
    for k in range(3):
        write_json(f"{st.landing}/selic_{2030 + k}.json", [{"data": f"01/01/{2030 + k}", "valor": "0.05"}])
        report = run(spark, st, stop_on_failure=False)
        assert report.metrics["bronze"]["rows_ingested"] == 1
        assert report.metrics["bronze"]["landing_files"] == 3 + k  # both places are counted
    assert "selic.json" not in _names(st.landing) and {"selic.json", "ipca.json"} <= set(_names(st.archive))
    assert len(_names(st.landing)) + len(_names(st.archive)) == 5
    assert not [r for r in report.results if r.name.startswith("landing_files") and not r.passed]
    assert silver_table(spark, st).count() == len(sel) + len(ipc) + 3
    # a file that comes again under its old name is read again, though the stream knows that name
    sel[0]["valor"] = "0.07"
    write_json(f"{st.landing}/selic.json", sel)
    later = os.stat(f"{st.landing}/selic.json").st_mtime + 5
    os.utime(f"{st.landing}/selic.json", (later, later))
    assert run(spark, st, stop_on_failure=False).metrics["bronze"]["files_changed"] == 1
    assert silver_table(spark, st).read().where("value = 0.07").count() == 1
    assert files_in(spark, st.archive) >= 4
