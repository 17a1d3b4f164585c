"""Three small uploads through the whole run, against the files they must become.

The tables are fixed test data: raw uploads and their expected output, as text.
"""

from sheafline.operators.clean import CleanOptions
from sheafline.operators.unify import UnifiedSchema
from sheafline.plans.harmonize import harmonize_folder

STANDARDS = {
    "time_period": "string", "jurisdiction": "string", "primary_cause": "string", "female_deaths": "integer", "m_count": "integer",
    "row_id": "integer", "sys_code": "string", "zilla": "string", "total_students": "integer", "pass_rate": "float",
    "institutions": "integer", "district": "string", "bed_capacity": "float", "opd_visits": "float", "specialists": "float"}
NAMES = ["Time_Period", "Jurisdiction", "Primary_Cause", "Female_Deaths", "M_Count", "Row_ID", "Sys_Code", "Zilla", "Total_Students",
         "Pass_Rate", "Institutions", "Dist", "Bed_Capacity", "OPD_Visits", "Specialists"]

PAIRS = {
    "education": ("""\
Zilla,Sys_Code,Institutions,Pass_Rate,Total_Students
Lucknow,X-14,156,89.32,22304
Varanasi,X-26,185,87.19,19094
Lucknow,X-40,95,84.92,35249
Bhopal,X-68,75,96.54,11867
Bhopal,X-78,139,73.81,49782
Nagpur,X-85,56,94.35,43888
Varanasi,X-62,111,79.76,44491
Jaipur,X-11,128,93.08,26628
Indore,X-91,80,92.13,37468
Varanasi,X-95,77,92.72,14845
""", """\
sys_code,zilla,total_students,pass_rate,institutions
X-14,Lucknow,22304,89.32,156
X-26,Varanasi,19094,87.19,185
X-40,Lucknow,35249,84.92,95
X-68,Bhopal,11867,96.54,75
X-78,Bhopal,49782,73.81,139
X-85,Nagpur,43888,94.35,56
X-62,Varanasi,44491,79.76,111
X-11,Jaipur,26628,93.08,128
X-91,Indore,37468,92.13,80
X-95,Varanasi,14845,92.72,77
"""),
    "health": ("""\
Bed_Capacity,OPD_Visits,Dist,Specialists
3792.0,37707.0,,297.0
1689.0,61905.0,Lucknow,349.0
3021.0,23040.0,Varanasi,61.0
4128.0,18901.0,Lucknow,31.0
4859.0,61598.0,Jaipur,318.0
4656.0,51702.0,Lucknow,
,10637.0,,279.0
4851.0,81479.0,Bhopal,429.0
1634.0,75556.0,Kota,87.0
1421.0,,Bhopal,33.0
""", """\
district,bed_capacity,opd_visits,specialists
nan,3792.0,37707.0,297.0
Lucknow,1689.0,61905.0,349.0
Varanasi,3021.0,23040.0,61.0
Lucknow,4128.0,18901.0,31.0
Jaipur,4859.0,61598.0,318.0
Lucknow,4656.0,51702.0,
nan,,10637.0,279.0
Bhopal,4851.0,81479.0,429.0
Kota,1634.0,75556.0,87.0
Bhopal,1421.0,,33.0
"""),
    "deaths": ("""\
Time_Period,Jurisdiction,Primary_Cause,Female_Deaths,M_Count,Sys_Code,Row_ID
2022,Bhopal,,100,459,X-52,0
2022,Varanasi,Family,163,145,X-54,1
2024,,Health,139,121,X-77,2
2022,,Health,66,126,X-45,3
2022,Nagpur,Family,57,102,X-26,4
2023,Indore,Other,188,466,X-53,5
2024,Jaipur,Other,66,97,X-13,6
2023,Indore,Other,138,11,X-87,7
2023,Indore,Financial,28,285,X-96,8
2022,Indore,Other,42,190,X-69,9
""", """\
time_period,jurisdiction,primary_cause,female_deaths,m_count,row_id,sys_code
2022,Bhopal,nan,100,459,0,X-52
2022,Varanasi,Family,163,145,1,X-54
2024,nan,Health,139,121,2,X-77
2022,nan,Health,66,126,3,X-45
2022,Nagpur,Family,57,102,4,X-26
2023,Indore,Other,188,466,5,X-53
2024,Jaipur,Other,66,97,6,X-13
2023,Indore,Other,138,11,7,X-87
2023,Indore,Financial,28,285,8,X-96
2022,Indore,Other,42,190,9,X-69
"""),
}


def shown(value) -> str:
    return "" if value is None else str(value)


def test_uploads_become_the_expected_files(spark, tmp_path):
    for name, (upload, _) in PAIRS.items():
        (tmp_path / f"{name}.csv").write_text(upload)
    schema = UnifiedSchema({s: [n] for s, n in zip(STANDARDS, NAMES)}, STANDARDS)
    done = harmonize_folder(spark, str(tmp_path), CleanOptions(infer=True, nullable_ints=False), proposal=schema.to_json(), null_as_text="nan")
    for name, (_, expected) in PAIRS.items():
        header, *rows = [line.split(",") for line in expected.splitlines()]
        frame = done.frames[f"{name}.csv"]
        assert frame.columns == header
        assert sorted([shown(v) for v in r] for r in frame.collect()) == sorted(rows)
