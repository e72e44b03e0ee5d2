"""Small wire payloads, typed by hand in the shape of the three feeds."""

import json

NATIONAL = {"data": [{"from": "2027-07-11T14:30Z", "to": "2027-07-11T15:00Z",
                      "intensity": {"forecast": 143, "actual": 151, "index": "moderate"}}]}

NATIONAL_NULL_ACTUAL = {"data": [{"from": "2027-07-11T15:00Z", "to": "2027-07-11T15:30Z",
                                  "intensity": {"forecast": 137, "actual": None, "index": "moderate"}}]}


def regional(n_regions=18, period="2027-07-11T14:30Z", end="2027-07-11T15:00Z"):
    regions = []
    for rid in range(1, n_regions + 1):
        regions.append({
            "regionid": rid, "dnoregion": f"Region {rid}", "shortname": f"R{rid}",
            "intensity": {"forecast": 0 if rid == 3 else 20 * rid, "index": "very low" if rid < 5 else "moderate"},
            "generationmix": [{"fuel": "wind", "perc": 60.1}, {"fuel": "gas", "perc": 39.9}],
        })
    return {"data": [{"from": period, "to": end, "regions": regions}]}


FUELS = ["GAS", "COAL", "NUCLEAR", "WIND", "WIND_EMB", "HYDRO", "IMPORTS", "BIOMASS", "OTHER",
         "SOLAR", "STORAGE"]


def mix_record(i, dt, base):
    r = {"_id": i, "DATETIME": dt}
    vals = {"GAS": 9000.0 + base, "COAL": 0.0, "NUCLEAR": 4000.0, "WIND": 12000.5, "WIND_EMB": 1500.0,
            "HYDRO": 111, "IMPORTS": 5000.0, "BIOMASS": 2000.0, "OTHER": 300.0, "SOLAR": 800.0,
            "STORAGE": -130.5}
    r.update(vals)
    total = sum(vals.values())
    r.update({"GENERATION": total, "CARBON_INTENSITY": 120.0, "LOW_CARBON": 20000.0,
              "ZERO_CARBON": 18000.0, "RENEWABLE": 16000.0, "FOSSIL": 9000.0})
    for f in FUELS:
        r[f + "_perc"] = round(100.0 * vals[f] / total, 1)
    for f in ["GENERATION", "LOW_CARBON", "ZERO_CARBON", "RENEWABLE", "FOSSIL"]:
        r[f + "_perc"] = 50.0
    return r


def generation_mix(success=True):
    recs = [mix_record(3, "2027-08-02T13:00:00", 100), mix_record(2, "2027-08-02T12:30:00", 50),
            mix_record(1, "2027-08-02T12:00:00", 0)]
    return {"success": success, "help": "https://example.invalid/help",
            "result": {"records": recs, "total": 3, "fields": [], "_links": {}}}


def prices(n=4, start_hour=10):
    res = []
    for k in range(n):
        h, m = divmod(start_hour * 60 + 30 * k, 60)
        h2, m2 = divmod(start_hour * 60 + 30 * (k + 1), 60)
        res.append({"value_exc_vat": 10.0 + k, "value_inc_vat": 10.5 + k,
                    "valid_from": f"2027-07-11T{h:02d}:{m:02d}:00Z",
                    "valid_to": f"2027-07-11T{h2:02d}:{m2:02d}:00Z", "payment_method": None})
    return {"count": n, "next": None, "previous": None, "results": res}


def dumps(obj):
    return json.dumps(obj)
