"""The operators once more, as plain DuckDB SQL on the same tables.

Each is written the direct way (pairing joins, ranks, sub-queries) where the Spark
side aggregates first or runs windows, so that the two check each other.
"""

from __future__ import annotations

from checks.adapter_sql import INPUTS

WEIGHTS = """
weighed AS (
  SELECT *, round(adm / nullif(dis, 0), 2) AS ratio FROM stays
),
shifted AS (
  SELECT stay, adm * CASE WHEN ratio > 0.15 THEN 1 WHEN adm <= 1 THEN 100 WHEN adm <= 20 THEN 10 ELSE 1 END
                   / CASE WHEN ratio > 6.9 AND adm >= 300 THEN 10 ELSE 1 END AS adm,
         CASE WHEN ratio > 6.9 AND dis <= 20 THEN NULL
              WHEN ratio <= 0.15 AND dis >= 300 THEN dis / 10 ELSE dis END AS dis
  FROM weighed WHERE least(adm, dis) > 0 AND adm IS NOT NULL AND dis IS NOT NULL
  UNION
  SELECT stay, adm, dis FROM stays WHERE adm IS NULL OR dis IS NULL
),
weights AS (
  SELECT stay, CASE WHEN stay IN (1355321, 2387379) THEN dis WHEN adm < 2.5 THEN NULL ELSE adm END AS adm, dis
  FROM shifted
)
"""

# --- fixed values: the labels whose rate is a dose, with its unit -----------------
DRUGS = """
accepted(drug, name, unit) AS (VALUES
  ('dopamine', 'Dopamine (mcg/kg/min)', 'mcg/kg/min'),
  ('dopamine', 'dopamine (mcg/kg/min)', 'mcg/kg/min'),
  ('dopamine', 'DOPamine STD 15 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)', 'mcg/kg/min'),
  ('dopamine', 'DOPamine STD 400 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)', 'mcg/kg/min'),
  ('dopamine', 'DOPamine STD 400 mg Dextrose 5% 500 ml  Premix (mcg/kg/min)', 'mcg/kg/min'),
  ('dopamine', 'DOPamine MAX 800 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)', 'mcg/kg/min'),
  ('dopamine', 'Dopamine (mcg/kg/hr)', 'mcg/kg/hr'),
  ('dopamine', 'Dopamine (mcg/hr)', 'mcg/hr'),
  ('dopamine', 'Dopamine (mcg/min)', 'mcg/min'),
  ('dopamine', 'Dopamine (mg/hr)', 'mg/hr'),
  ('dopamine', 'Dopamine (nanograms/kg/min)', 'nanograms/kg/min'),
  ('epinephrine', 'Epinephrine (mcg/min)', 'mcg/min'),
  ('epinephrine', 'EPINEPHrine(Adrenalin)STD 4 mg Sodium Chloride 0.9% 500 ml (mcg/min)', 'mcg/min'),
  ('epinephrine', 'EPINEPHrine(Adrenalin)STD 7 mg Sodium Chloride 0.9% 250 ml (mcg/min)', 'mcg/min'),
  ('epinephrine', 'EPINEPHrine(Adrenalin)MAX 30 mg Sodium Chloride 0.9% 250 ml (mcg/min)', 'mcg/min'),
  ('epinephrine', 'Epinephrine (mcg/kg/min)', 'mcg/kg/min'),
  ('epinephrine', 'Epinephrine (mcg/hr)', 'mcg/hr'),
  ('epinephrine', 'Epinephrine (mg/kg/min)', 'mg/kg/min'),
  ('epinephrine', 'Epinephrine (mg/hr)', 'mg/hr'),
  ('norepinephrine', 'Norepinephrine (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine STD 4 mg Dextrose 5% 250 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine STD 4 mg Dextrose 5% 500 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine STD 8 mg Dextrose 5% 250 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine STD 8 mg Dextrose 5% 500 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine STD 32 mg Dextrose 5% 282 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine STD 32 mg Dextrose 5% 500 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine MAX 32 mg Dextrose 5% 250 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine MAX 32 mg Dextrose 5% 500 ml (mcg/min)', 'mcg/min'),
  ('norepinephrine', 'Norepinephrine (mcg/kg/min)', 'mcg/kg/min'),
  ('norepinephrine', 'Norepinephrine (mcg/hr)', 'mcg/hr'),
  ('norepinephrine', 'Norepinephrine (mg/hr)', 'mg/hr'),
  ('norepinephrine', 'Norepinephrine (mcg/kg/hr)', 'mcg/kg/hr'),
  ('norepinephrine', 'Norepinephrine (mg/min)', 'mg/min'),
  ('norepinephrine', 'Norepinephrine (mg/kg/min)', 'mg/kg/min')
),
named AS (
  SELECT 'dobutamine' AS drug, * FROM infusions
  WHERE regexp_matches(name, 'Dobutamine|DOBUTamine') AND rate_text <> ''
  UNION ALL
  SELECT 'dopamine', * FROM infusions
  WHERE regexp_matches(name, 'dopamine|Dopamine|DOPamine')
    AND rate_text NOT IN ('OFF', 'ERROR', 'UD', '') AND NOT contains(rate_text, 'Time Correction')
  UNION ALL
  SELECT 'epinephrine', * FROM infusions
  WHERE regexp_matches(name, '^(Epinephrine|EPINEPHrine)')
    AND NOT regexp_matches(rate_text, 'OFF|50.*mcg|br') AND rate_text <> ''
  UNION ALL
  SELECT 'norepinephrine', * FROM infusions
  WHERE regexp_matches(name, 'Norepinephrine|norepinephrine')
    AND rate_text NOT IN ('Documentation undone', 'ERROR', 'UD', '') AND NOT contains(rate_text, 'OFF')
),
numeric_rows AS (
  SELECT *, try_cast(rate_text AS DOUBLE) AS r, coalesce(off, -1099511627776) AS minute FROM named WHERE try_cast(rate_text AS DOUBLE) IS NOT NULL
),
gaps AS (
  SELECT DISTINCT drug, stay FROM numeric_rows
  WHERE name IN ('Dopamine ()', 'Epinephrine ()', 'Norepinephrine ()')
),
in_gap AS (
  SELECT n.* FROM numeric_rows n JOIN gaps USING (drug, stay)
  WHERE (drug = 'dopamine' AND contains(name, 'Dopamine'))
     OR (drug = 'epinephrine' AND starts_with(name, 'Epinephrine')) OR drug = 'norepinephrine'
),
telling AS (
  SELECT drug, stay, minute, id, if(contains(name, 'norepinephrine'), 'Norepinephrine (ml/hr)', name) AS label
  FROM in_gap
  WHERE name IN ('Dopamine', 'Epinephrine', 'Norepinephrine')
     OR contains(name, 'norepinephrine')
     OR (drug <> 'epinephrine' AND name IN ('Dopamine (mcg/kg/hr)', 'Dopamine (mcg/kg/min)', 'Dopamine (ml/hr)',
           'Norepinephrine (mcg/kg/hr)', 'Norepinephrine (mcg/kg/min)', 'Norepinephrine (ml/hr)'))
     OR (drug = 'norepinephrine' AND name IN ('Norepinephrine (mcg/min)', 'Norepinephrine (mg/hr)', 'Norepinephrine (mg/min)'))
),
told AS (
  SELECT g.drug, g.id,
    coalesce(arg_max(t.label, t.minute::HUGEINT * 1000000000000 + t.id) FILTER (t.minute <= g.minute),
             arg_min(t.label, t.minute::HUGEINT * 1000000000000 - t.id) FILTER (t.minute > g.minute)) AS label
  FROM in_gap g LEFT JOIN telling t ON t.drug = g.drug AND t.stay = g.stay
  GROUP BY g.drug, g.id
),
labelled AS (
  SELECT g.* REPLACE (t.label AS name) FROM in_gap g JOIN told t USING (drug, id)
  UNION
  SELECT n.* FROM numeric_rows n
  WHERE NOT EXISTS (SELECT 1 FROM gaps WHERE gaps.drug = n.drug AND gaps.stay = n.stay)
    AND contains(name, CASE drug WHEN 'dopamine' THEN 'dopamine' WHEN 'epinephrine' THEN 'Epinephrine'
                                 WHEN 'norepinephrine' THEN 'Norepinephrine' END)
    AND (drug <> 'epinephrine' OR starts_with(name, 'Epinephrine'))
),
dosed AS (
  SELECT l.*, coalesce(w.adm, w.dis, 80) AS kg FROM labelled l LEFT JOIN weights w USING (stay)
),
units(unit, num, den, per_kg) AS (
  VALUES ('mcg/kg/min', 1, 1, false), ('mcg/kg/hr', 1, 60, false), ('mcg/hr', 1, 60, true),
         ('mcg/min', 1, 1, true), ('mg/hr', 1000, 60, true), ('mg/min', 1000, 1, true),
         ('mg/kg/min', 1000, 1, false), ('nanograms/kg/min', 1, 1000, false)
),
unit_known AS (
  SELECT * FROM dosed JOIN accepted USING (drug, name)
),
label_rates AS (
  SELECT u.* EXCLUDE (unit), num * r / (den * if(per_kg, kg, 1)) AS rate FROM unit_known u JOIN units USING (unit)
),
volume_rates AS (
  SELECT *, 1000 * r * 4 / (250 * 60 * kg) AS rate FROM dosed WHERE name = 'Dopamine (ml/hr)'
  UNION
  SELECT d.*, 1000 * r * if(o.name = 'EPINEPHrine 8 MG in 250 mL NS', 8, 4) / (250 * 60 * kg)
  FROM dosed d JOIN drug_orders o ON o.stay = d.stay AND d.off BETWEEN o.start_off AND o.stop_off
  WHERE d.name = 'Epinephrine (ml/hr)' AND o.cancelled = 'No' AND starts_with(o.name, 'Epinephrine')
  UNION
  SELECT d.*, CASE WHEN o.name LIKE 'NOREPINEPHRINE%4%MG%250%C%REPACKAGE%' THEN 1000 * r * 4 / (250 * 60 * kg) END
  FROM dosed d JOIN drug_orders o ON o.stay = d.stay AND d.off BETWEEN o.start_off AND o.stop_off
  WHERE d.name IN ('Norepinephrine (ml/hr)', 'norepinephrine Volume (ml) (ml/hr)')
    AND o.cancelled = 'No' AND contains(o.name, 'Norepinephrine')
),
rates AS (
  SELECT drug, id, stay, off, name, round(rate, 4) AS rate, infusionrate, drugamount, volumeoffluid, patientweight
  FROM (SELECT * FROM label_rates UNION SELECT * FROM volume_rates)
  UNION ALL
  SELECT drug, id, stay, off, name, round(r, 4), infusionrate, drugamount, volumeoffluid, patientweight
  FROM numeric_rows WHERE drug = 'dobutamine'
)
"""

PRESSURES = """
readings AS (
  SELECT stay, off, 1 AS src, s, d, m FROM cuff WHERE kind IN ('view', 'purchase')
    AND coalesce(s, 0) + coalesce(d, 0) + coalesce(m, 0) <> 0
  UNION ALL
  SELECT stay, off, 2, s + 1, d, m FROM cuff WHERE kind = 'click'
    AND coalesce(s + 1, 0) + coalesce(d, 0) + coalesce(m, 0) <> 0
  UNION ALL
  SELECT stay, off, 3, s, d, m FROM cuff WHERE kind = 'error' AND 2 * coalesce(s, 0) + coalesce(m, 0) <> 0
  UNION ALL
  SELECT stay, off, 4, s, d, m FROM cuff WHERE kind IN ('click', 'signup')
    AND coalesce(s, 0) + coalesce(d, 0) + coalesce(m, 0) <> 0
),
long_readings AS (
  UNPIVOT (SELECT stay, off, src, s AS sbp, d AS dbp, round(coalesce(m, d + (s - d) / 3), 0) AS map FROM readings)
  ON sbp, dbp, map INTO NAME what VALUE x
),
best AS (
  SELECT stay, off, what, x FROM long_readings
  WHERE x > 0 AND x < if(what = 'sbp', 400, 300)
  QUALIFY row_number() OVER (PARTITION BY stay, off, what ORDER BY src, x) = 1
),
pressures AS (
  SELECT t.stay, t.off,
         (SELECT x FROM best b WHERE b.stay = t.stay AND b.off = t.off AND what = 'sbp') AS sbp,
         (SELECT x FROM best b WHERE b.stay = t.stay AND b.off = t.off AND what = 'dbp') AS dbp,
         (SELECT x FROM best b WHERE b.stay = t.stay AND b.off = t.off AND what = 'map') AS map
  FROM (SELECT DISTINCT stay, off FROM readings) t
)
"""

VENT = """
flagged AS (
  SELECT *, (starts_with(item, 'Intubated') OR item IN (
      'Ventilated - chronic dependency', 'Ventilated - with daily extubation evaluation',
      'Ventilated - with no daily extubation trial', 'Non-invasive ventilation'))::INT AS on_off
  FROM careplan WHERE grp IN ('Airway', 'Ventilation') AND item <> ''
),
undisputed AS (
  SELECT * FROM flagged
  QUALIFY NOT (on_off = 0 AND off IS NOT NULL AND max(on_off) OVER (PARTITION BY stay, off) = 1
               AND row_number() OVER (PARTITION BY stay, off, on_off ORDER BY item, id) = 1)
),
settled AS (
  SELECT * FROM undisputed WHERE on_off = 1
  QUALIFY row_number() OVER (PARTITION BY stay, off ORDER BY item, id) = 1
  UNION ALL
  SELECT * FROM undisputed WHERE on_off = 0
  QUALIFY row_number() OVER (PARTITION BY stay, off ORDER BY item DESC, id DESC) = 1
),
trimmed AS (
  SELECT s.* FROM settled s
  JOIN (SELECT stay, min(off) AS begin_off, bool_or(off IS NULL) AS from_start
        FROM settled WHERE on_off = 1 GROUP BY stay) f USING (stay)
  WHERE from_start OR s.off >= begin_off
),
tail1 AS (
  SELECT * FROM trimmed
  QUALIFY row_number() OVER (PARTITION BY stay ORDER BY off DESC NULLS LAST, on_off, id DESC) = 1
),
after_tail AS (
  SELECT * FROM trimmed
  UNION ALL
  SELECT id, stay, off + 60, active, grp, 'Spontaneous - adequate', 0 FROM tail1
  WHERE on_off = 1 AND active IS NOT DISTINCT FROM false
),
ends AS (
  SELECT *, row_number() OVER (PARTITION BY stay ORDER BY off DESC NULLS LAST, on_off, id DESC) AS from_end
  FROM after_tail
),
paired AS (
  SELECT e.id, e.stay, e.off,
         CASE WHEN p.stay IS NOT NULL THEN false ELSE e.active END AS active, e.grp,
         CASE WHEN p.stay IS NOT NULL THEN 'Spontaneous - adequate' ELSE e.item END AS item, e.on_off
  FROM ends e
  LEFT JOIN (SELECT stay FROM ends WHERE from_end = 2 AND on_off = 1 AND active) p
    ON p.stay = e.stay AND e.from_end = 1 AND e.on_off = 0
),
closed AS (
  SELECT * FROM paired
  UNION ALL
  SELECT t.id, t.stay, s.discharge, false, 'Airway', 'Spontaneous - adequate', 0
  FROM (SELECT * FROM paired
        QUALIFY row_number() OVER (PARTITION BY stay ORDER BY off DESC NULLS LAST, on_off, id DESC) = 1) t
  LEFT JOIN (SELECT DISTINCT stay, discharge FROM stays) s USING (stay)
  WHERE t.on_off = 1 AND t.active
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY stay ORDER BY off NULLS FIRST, on_off DESC, id) AS n FROM closed
),
moments AS (
  SELECT stay, point, row_number() OVER (PARTITION BY stay ORDER BY point) AS k
  FROM (
    SELECT a.stay, a.off AS point FROM numbered a JOIN numbered b ON b.stay = a.stay AND b.n = a.n + 1 WHERE a.on_off = 1
    UNION
    SELECT a.stay, b.off FROM numbered a JOIN numbered b ON b.stay = a.stay AND b.n = a.n + 1 WHERE a.on_off = 1
  ) WHERE point IS NOT NULL
),
vent AS (
  SELECT a.stay, a.point AS starttime, b.point AS endtime
  FROM moments a JOIN moments b ON b.stay = a.stay AND b.k = a.k + 1 WHERE a.k % 2 = 1
),
timed AS (
  SELECT * REPLACE (row_number() OVER (PARTITION BY stay ORDER BY off, on_off DESC, id) AS n)
  FROM numbered WHERE off IS NOT NULL
),
runs AS (
  SELECT a.stay, a.off AS starttime,
         (SELECT min(z.off) FROM timed z WHERE z.stay = a.stay AND z.n > a.n AND z.on_off = 0) AS endtime
  FROM timed a LEFT JOIN timed before ON before.stay = a.stay AND before.n = a.n - 1
  WHERE a.on_off = 1 AND coalesce(before.on_off, 0) = 0
)
"""

SCORES = """
grid AS (
  SELECT stay, unnest(range(-24, ceil(discharge / 60.0)::INT + 1))::INT AS hr
  FROM (SELECT DISTINCT stay, discharge FROM stays WHERE age <> '')
),
pf AS (
  SELECT g.id, g.stay, g.off, round(pao2 / nullif(fio2, 0), 0) AS ratio,
         EXISTS (SELECT 1 FROM vent v WHERE v.stay = g.stay AND g.off BETWEEN v.starttime AND v.endtime) AS vented
  FROM gases g WHERE pao2 IS NOT NULL AND fio2 IS NOT NULL
),
everything AS (
  SELECT * FROM measured
  UNION ALL SELECT stay, off, 'map', map FROM pressures WHERE map > 0 AND map < 300
  UNION ALL SELECT stay, off, if(vented, 'pf_vent', 'pf_novent'), ratio FROM pf
  UNION ALL SELECT stay, off, drug, rate FROM rates WHERE rate > 0
),
panel AS (
  SELECT g.stay, g.hr,
    min(x) FILTER (what = 'map') AS map, min(x) FILTER (what = 'gcs') AS gcs,
    max(x) FILTER (what = 'bilirubin') AS bili, max(x) FILTER (what = 'creatinine') AS creat,
    min(x) FILTER (what = 'platelets') AS plate,
    min(x) FILTER (what = 'pf_novent') AS pf_novent, min(x) FILTER (what = 'pf_vent') AS pf_vent,
    max(x) FILTER (what = 'norepinephrine') AS nor, max(x) FILTER (what = 'epinephrine') AS epi,
    max(x) FILTER (what = 'dobutamine') AS dobu, max(x) FILTER (what = 'dopamine') AS dopa,
    sum(x) FILTER (what = 'urine') AS urine
  FROM grid g LEFT JOIN everything e
    ON e.stay = g.stay AND e.off > 60 * (g.hr - 1) AND e.off <= 60 * g.hr
  GROUP BY g.stay, g.hr
),
day AS (
  SELECT *, sum(urine) OVER (PARTITION BY stay ORDER BY hr RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS urine_day
  FROM panel
),
organs AS (
  SELECT *,
    if(pf_vent IS NULL AND pf_novent IS NULL, NULL, greatest(
      if(coalesce(pf_vent, 999) < 200, 3 + (pf_vent < 100)::INT, 0),
      if(coalesce(pf_novent, 999) < 400, 1 + (pf_novent < 300)::INT, 0))) AS respiration,
    (plate < 150)::INT + (plate < 100)::INT + (plate < 50)::INT + (plate < 20)::INT AS coagulation,
    (bili >= 1.2)::INT + (bili >= 2)::INT + (bili >= 6)::INT + (bili >= 12)::INT AS liver,
    if(coalesce(map, dopa, dobu, epi, nor) IS NULL, NULL, greatest(
      if(coalesce(epi, -1) >= 0, 3 + (epi > 0.1)::INT, 0), if(coalesce(nor, -1) >= 0, 3 + (nor > 0.1)::INT, 0),
      if(coalesce(dopa, 0) > 0, 2 + (dopa > 5)::INT + (dopa > 15)::INT, 0),
      if(coalesce(dobu, 0) > 0, 2, 0), (coalesce(map, 99) < 70)::INT)) AS cardiovascular,
    (gcs < 15)::INT + (gcs < 13)::INT + (gcs < 10)::INT + (gcs < 6)::INT AS cns,
    if(creat IS NULL AND urine_day IS NULL, NULL, greatest(
      coalesce((creat >= 1.2)::INT + (creat >= 2)::INT + (creat >= 3.5)::INT + (creat >= 5)::INT, 0),
      if(coalesce(urine_day, 999) < 500, 3 + (urine_day < 200)::INT, 0))) AS renal
  FROM day
),
worst AS (
  SELECT *,
    coalesce(max(respiration) OVER d, 0) AS respiration_24hours,
    coalesce(max(coagulation) OVER d, 0) AS coagulation_24hours,
    coalesce(max(liver) OVER d, 0) AS liver_24hours,
    coalesce(max(cardiovascular) OVER d, 0) AS cardiovascular_24hours,
    coalesce(max(cns) OVER d, 0) AS cns_24hours,
    coalesce(max(renal) OVER d, 0) AS renal_24hours
  FROM organs
  WINDOW d AS (PARTITION BY stay ORDER BY hr RANGE BETWEEN 23 PRECEDING AND CURRENT ROW)
)
"""

CTES = ",".join([INPUTS, WEIGHTS, DRUGS, PRESSURES, VENT, SCORES])

RATE_COLUMNS = (
    "id AS infusiondrugid, stay AS patientunitstayid, off AS infusionoffset, name AS drugname,"
    " rate AS rate_{drug}, infusionrate, drugamount, volumeoffluid, patientweight"
)
EVENT_COLUMNS = (
    "id AS cplgeneralid, stay AS patientunitstayid, active AS activeupondischarge,"
    " off AS cplitemoffset, grp AS cplgroup, item AS cplitemvalue, on_off AS vent_flag"
)
PANEL_COLUMNS = (
    "stay AS patientunitstayid, hr, map AS MeanBP_min, gcs AS GCS_min, bili AS bilirubin_max,"
    " creat AS creatinine_max, plate AS platelet_min, pf_novent AS PaO2FiO2Ratio_novent,"
    " pf_vent AS PaO2FiO2Ratio_vent, nor AS rate_norepinephrine, epi AS rate_epinephrine,"
    " dobu AS rate_dobutamine, dopa AS rate_dopamine, urine AS urineoutput"
)
ORGANS = "respiration, coagulation, liver, cardiovascular, cns, renal"
WORST = ", ".join(f"{o}_24hours" for o in ORGANS.split(", "))
TOTAL = "(" + " + ".join(f"{o}_24hours" for o in ORGANS.split(", ")) + ") AS SOFA_24hours"

# whole numbers of billionths, divided once; a half goes away from zero
EXACT = """
  SELECT drug, infusiondrugid, patientunitstayid, infusionoffset, drugname,
    if(top IS NULL, NULL, (if(top < 0, -1, 1) * ((abs(top) * 20000 + bottom) // (2 * bottom)))::DECIMAL(18,0) * 0.0001)::DECIMAL(18,4)::VARCHAR AS rate
  FROM (
    SELECT drug, id AS infusiondrugid, stay AS patientunitstayid, off AS infusionoffset, name AS drugname, plain, infusionrate,
      (num * (try_cast(rate_text AS DECIMAL(20,9)) * 1000000000)::HUGEINT)::HUGEINT AS top,
      (den * if(per_kg, (kg::DECIMAL(20,9) * 1000000000)::HUGEINT, 1000000000))::HUGEINT AS bottom
    FROM (
      SELECT u.* EXCLUDE (unit, num, den, per_kg), num, den, per_kg, num * r / (den * if(per_kg, kg, 1)) AS plain FROM (unit_known JOIN units USING (unit)) u
      UNION
      SELECT *, 4000, 15000, true, 1000 * r * 4 / (250 * 60 * kg) FROM dosed WHERE name = 'Dopamine (ml/hr)'
      UNION
      SELECT d.*, if(o.name = 'EPINEPHrine 8 MG in 250 mL NS', 8000, 4000), 15000, true, 1000 * r * if(o.name = 'EPINEPHrine 8 MG in 250 mL NS', 8, 4) / (250 * 60 * kg)
      FROM dosed d JOIN drug_orders o ON o.stay = d.stay AND d.off BETWEEN o.start_off AND o.stop_off
      WHERE d.name = 'Epinephrine (ml/hr)' AND o.cancelled = 'No' AND starts_with(o.name, 'Epinephrine')
      UNION
      SELECT d.*, CASE WHEN o.name LIKE 'NOREPINEPHRINE%4%MG%250%C%REPACKAGE%' THEN 4000 END, 15000, true,
        CASE WHEN o.name LIKE 'NOREPINEPHRINE%4%MG%250%C%REPACKAGE%' THEN 1000 * r * 4 / (250 * 60 * kg) END
      FROM dosed d JOIN drug_orders o ON o.stay = d.stay AND d.off BETWEEN o.start_off AND o.stop_off
      WHERE d.name IN ('Norepinephrine (ml/hr)', 'norepinephrine Volume (ml) (ml/hr)')
        AND o.cancelled = 'No' AND contains(o.name, 'Norepinephrine')
      UNION ALL
      SELECT *, NULL::DOUBLE, 1, 1, false, r FROM numeric_rows WHERE drug = 'dobutamine'))"""

FINAL = {
    "weight_repair": "SELECT stay AS patientunitstayid, adm AS admissionweight, dis AS dischargeweight FROM weights",
    "infusion_parse": "SELECT drug, id AS infusiondrugid, stay AS patientunitstayid, off AS infusionoffset,"
    " name AS drugname, r AS rate FROM numeric_rows",
    "infusion_rejects": "SELECT drug, id AS infusiondrugid, name AS drugname, rate_text AS drugrate FROM named"
    " WHERE rate_text IS NOT NULL AND try_cast(rate_text AS DOUBLE) IS NULL",
    "unit_locf_nocb": "SELECT drug, id AS infusiondrugid, stay AS patientunitstayid, off AS infusionoffset,"
    " name AS drugname, r AS rate FROM labelled WHERE drug <> 'dobutamine'",
    "volume_rate_by_order": "SELECT drug, id AS infusiondrugid, stay AS patientunitstayid, off AS infusionoffset,"
    " name AS drugname, round(rate, 4) AS rate FROM volume_rates",
    **{
        f"rate_{drug}": f"SELECT {RATE_COLUMNS.format(drug=drug)} FROM rates WHERE drug = '{drug}'"
        for drug in ("dobutamine", "dopamine", "epinephrine", "norepinephrine")
    },
    "pressure_coalesce": "SELECT stay AS patientunitstayid, off AS observationoffset, sbp, dbp, map FROM pressures",
    "pressure_min": "SELECT stay AS patientunitstayid, off AS chartoffset, min(map) AS MeanBP_min FROM pressures"
    " WHERE map > 0 AND map < 300 GROUP BY ALL",
    **{
        name: f"SELECT {EVENT_COLUMNS} FROM {cte}"
        for name, cte in {
            "vent_classify": "flagged",
            "vent_same_instant": "settled",
            "vent_trim": "trimmed",
            "vent_tail_close": "after_tail",
            "vent_last_pair": "paired",
            "vent_discharge_close": "closed",
        }.items()
    },
    "vent_episodes_reference": "SELECT stay AS patientunitstayid, starttime, endtime FROM vent",
    "vent_episodes_islands": "SELECT stay AS patientunitstayid, starttime, endtime FROM runs WHERE endtime IS NOT NULL",
    "cohort": "SELECT stay AS patientunitstayid, ceil(discharge / 60.0)::INT AS los_icu_hours,"
    " if(age = '> 89', 91.4, age::DOUBLE)::DOUBLE AS age FROM stays WHERE age <> ''",
    "hour_grid": "SELECT stay AS patientunitstayid, hr FROM grid",
    "hourly_min_bucket": "SELECT DISTINCT e.stay AS patientunitstayid, h::INT AS hr,"
    " (SELECT min(x) FROM measured i WHERE what = 'platelets' AND i.stay = e.stay"
    "   AND i.off > 60 * (h - 1) AND i.off <= 60 * h) AS platelet_min"
    " FROM measured e, range(-24, 800) t(h) WHERE what = 'platelets' AND off > 60 * (h - 1) AND off <= 60 * h",
    "hourly_urine": "SELECT stay AS patientunitstayid, hr, urine AS urineoutput FROM panel",
    "pf_by_vent": "SELECT stay AS patientunitstayid, off AS chartoffset,"
    " if(vented, NULL, ratio) AS PaO2FiO2Ratio_novent, if(vented, ratio, NULL) AS PaO2FiO2Ratio_vent FROM pf",
    "hourly_panel": f"SELECT {PANEL_COLUMNS} FROM panel",
    "band_respiration": "SELECT stay AS patientunitstayid, hr, pf_vent AS PaO2FiO2Ratio_vent,"
    " pf_novent AS PaO2FiO2Ratio_novent, respiration FROM organs",
    "band_coagulation": "SELECT stay AS patientunitstayid, hr, plate AS platelet_min, coagulation FROM organs",
    "band_liver": "SELECT stay AS patientunitstayid, hr, bili AS bilirubin_max, liver FROM organs",
    "band_cardiovascular": "SELECT stay AS patientunitstayid, hr, map AS MeanBP_min, cardiovascular FROM organs",
    "band_cns": "SELECT stay AS patientunitstayid, hr, gcs AS GCS_min, cns FROM organs",
    "renal_rolling_urine": "SELECT stay AS patientunitstayid, hr, creat AS creatinine_max,"
    " urine_day AS urine_24hours, renal FROM organs",
    "rolling_worst_24": "SELECT stay AS patientunitstayid, hr, coagulation, coagulation_24hours FROM worst",
    "sofa_total": f"SELECT stay AS patientunitstayid, hr, {WORST}, {TOTAL} FROM worst WHERE hr >= 0",
    "sofa_full": f"SELECT {PANEL_COLUMNS}, {ORGANS}, {WORST}, {TOTAL} FROM worst WHERE hr >= 0",
    "rate_exact": EXACT,
    "gas_episodes": "SELECT p.stay AS patientunitstayid, off AS chartoffset, ratio AS pao2fio2ratio, starttime, endtime,"
    " (off - starttime)::INT AS minutes_in FROM pf p LEFT JOIN vent v ON v.stay = p.stay AND off BETWEEN starttime AND endtime",
    "rolling_worst_by_change": "SELECT stay AS patientunitstayid, hr, coagulation, coagulation_24hours FROM worst",
    "rolling_urine_by_change": "SELECT stay AS patientunitstayid, hr, urine AS urineoutput, urine_day AS urineoutput_24hours FROM organs",
    "refreshed_sofa": f"SELECT {PANEL_COLUMNS}, {ORGANS}, {WORST}, {TOTAL} FROM worst WHERE hr >= 0",
    "refreshed_ventilation": "SELECT stay AS patientunitstayid, starttime, endtime FROM vent",
    "bucketed_sofa": f"SELECT {PANEL_COLUMNS}, {ORGANS}, {WORST}, {TOTAL} FROM worst WHERE hr >= 0",
    "streamed_sofa": f"SELECT stay AS patientunitstayid, hr, {WORST}, {TOTAL} FROM worst WHERE hr >= 0",
    "written_tables": f"SELECT stay AS patientunitstayid, hr, {WORST}, {TOTAL} FROM worst WHERE hr >= 0",
}


def _inputs() -> dict[str, tuple]:
    """Table -> (rows, columns that must not be NULL, column that must not repeat, minute)."""
    lab = "if(id % 71 <> 0, off, NULL)"
    return {
        "infusiondrug": ("infusions", {"infusiondrugid": "id", "patientunitstayid": "stay"}, "id", "off"),
        "medication": ("drug_orders", {"patientunitstayid": "stay"}, None, "start_off"),
        "careplangeneral": ("careplan", {"cplgeneralid": "id", "patientunitstayid": "stay"}, "id", "off"),
        "vitalperiodic": (
            "(FROM cuff WHERE kind IN ('view', 'purchase'))",
            {"patientunitstayid": "stay", "observationoffset": "off"},
            None,
            "off",
        ),
        "vitalaperiodic": (
            "(FROM cuff WHERE kind = 'error')",
            {"patientunitstayid": "stay", "observationoffset": "off"},
            None,
            "off",
        ),
        "pivoted_vital": (
            "(FROM cuff WHERE kind IN ('click', 'signup'))",
            {"patientunitstayid": "stay", "chartoffset": "off"},
            None,
            "off",
        ),
        "icustay_detail": ("stays", {"patientunitstayid": "stay"}, "stay", "NULL"),
        "pivoted_bg": ("gases", {"patientunitstayid": "stay", "chartoffset": "off"}, None, "off"),
        "pivoted_score": ("obs", {"patientunitstayid": "stay", "chartoffset": "off"}, None, "off"),
        "pivoted_lab": ("obs", {"patientunitstayid": "stay", "chartoffset": lab}, None, lab),
        "pivoted_uo": ("obs", {"patientunitstayid": "stay", "chartoffset": "off"}, None, "off"),
    }


def _violations() -> str:
    """A count for each rule of each input table."""
    parts = [
        "SELECT 'pivoted_bg' AS \"table\", 'fio2 is no fraction' AS rule,"
        " count(*) FILTER (NOT (fio2 > 0 AND fio2 <= 1)) AS \"rows\" FROM gases"
    ]
    for table, (rows, known, single, _) in _inputs().items():
        for column, value in known.items():
            parts.append(f"SELECT '{table}', '{column} is null', count(*) FILTER ({value} IS NULL) FROM {rows}")
            if value == single:
                parts.append(
                    f"SELECT '{table}', '{column} is repeated', count({value}) - count(DISTINCT {value}) FROM {rows}"
                )
    return " UNION ALL ".join(parts)


def _quarantine() -> str:
    """The rows behind these counts."""
    parts = []
    for table, (rows, known, single, minute) in _inputs().items():
        rules = [f"if({value} IS NULL, '{column} is null', NULL)" for column, value in known.items()]
        if table == "pivoted_bg":
            rules.append("if(NOT (fio2 > 0 AND fio2 <= 1), 'fio2 is no fraction', NULL)")
        rules += [
            f"if(count({v}) OVER (PARTITION BY {v}) > 1, '{c} is repeated', NULL)" for c, v in known.items() if v == single
        ]
        record = next((v for c, v in known.items() if c in ("infusiondrugid", "cplgeneralid")), "NULL")
        parts.append(
            f"SELECT '{table}' AS \"table\", stay AS patientunitstayid, {record}::BIGINT AS record_id,"
            f" ({minute})::INT AS minute, concat_ws(', ', {', '.join(rules)}) AS rules FROM {rows}"
        )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE rules <> ''"


FINAL["contract_violations"] = _violations()
FINAL["contract_quarantine"] = _quarantine()
# written table -> the query that makes the same rows
WRITTEN = {
    "weight": "weight_repair",
    "dobutamine": "rate_dobutamine",
    "dopamine": "rate_dopamine",
    "epinephrine": "rate_epinephrine",
    "norepinephrine": "rate_norepinephrine",
    "blood_pressure": "pressure_coalesce",
    "ventilation": "vent_episodes_reference",
    "sofa": "sofa_full",
    "contract_violations": "contract_violations",
    "quarantine": "contract_quarantine",
    "infusion_rejects": None,
}
REJECTED = (
    "SELECT drug, id AS infusiondrugid, stay AS patientunitstayid, off AS infusionoffset, name AS drugname,"
    " rate_text AS drugrate, infusionrate, drugamount, volumeoffluid, patientweight FROM named"
    " WHERE rate_text IS NOT NULL AND try_cast(rate_text AS DOUBLE) IS NULL"
)
FINAL |= {f"written_{table}": FINAL.get(name, REJECTED) for table, name in WRITTEN.items()}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {CTES} {select}" for name, select in FINAL.items()}
