"""DuckDB CTEs that lay the clinical inputs over the event and customer tables."""

from __future__ import annotations

INPUTS = """
obs AS (
  SELECT event_id AS id, user_id AS stay, event_type AS kind, value AS v,
         (date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', ts)) - 1440)::INT AS off,
         (floor((date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', ts)) - 1440) / 720.0) * 720)::INT AS slot
  FROM events
),
stays AS (
  SELECT k AS stay,
         CASE k % 11 WHEN 0 THEN '' WHEN 1 THEN '> 89' WHEN 2 THEN NULL ELSE (20 + k % 60)::VARCHAR END AS age,
         (last - if(k % 5 = 0, 2880, 0))::INT AS discharge,
         CASE k % 20 WHEN 0 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 0 WHEN 5 THEN 7 WHEN 6 THEN 0.7::DOUBLE
                     WHEN 7 THEN 710 WHEN 8 THEN 71 WHEN 9 THEN 71 WHEN 10 THEN 71 WHEN 11 THEN 2
                     WHEN 12 THEN 1.9::DOUBLE ELSE 41 + 2 * (k % 40) END::DOUBLE AS adm,
         CASE k % 20 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 12 THEN NULL WHEN 4 THEN 0 WHEN 5 THEN 71
                     WHEN 6 THEN 71 WHEN 7 THEN 71 WHEN 8 THEN 710 WHEN 9 THEN 1200 WHEN 10 THEN 7
                     WHEN 11 THEN 2.1::DOUBLE ELSE 41 + 2 * (k % 40) + k % 5 END::DOUBLE AS dis
  FROM (SELECT c_custkey AS k, (SELECT max(off) FROM obs WHERE stay = c_custkey) AS last,
          unnest(range(if(c_custkey % 97 = 0, 2, 1))) AS copy FROM customer)
),
infusions AS (
  SELECT id, stay, CASE WHEN id % 73 <> 0 THEN slot END AS off,
    CASE
      WHEN id % 27 = 3 AND stay % 2 <> 1 THEN 'Norepinephrine (mg/min)'
      WHEN id % 27 = 10 AND stay % 3 <> 1 THEN 'Epinephrine (mg/hr)'
      WHEN id % 27 = 16 AND stay % 3 <> 0 THEN 'dopamine (mcg/kg/min)'
      ELSE ['Norepinephrine (mcg/min)', 'Norepinephrine (mcg/kg/min)', 'Norepinephrine (ml/hr)',
            'Norepinephrine ()', 'Norepinephrine STD 4 mg Dextrose 5% 250 ml (mcg/min)',
            'Norepinephrine (mcg/hr)', 'norepinephrine Volume (ml) (ml/hr)', 'Norepinephrine',
            'Epinephrine (mcg/min)', 'Epinephrine (ml/hr)', 'Epinephrine ()', 'Epinephrine',
            'EPINEPHrine(Adrenalin)STD 7 mg Sodium Chloride 0.9% 250 ml (mcg/min)',
            'Epinephrine (mcg/kg/min)', 'Dopamine (mcg/kg/min)', 'Dopamine (ml/hr)', 'Dopamine ()',
            'Dopamine (mcg/kg/hr)', 'dopamine (mcg/kg/min)',
            'DOPamine STD 400 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)', 'Dobutamine (mcg/kg/min)',
            'DOBUTamine STD 500 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)',
            'Norepinephrine (mg/hr)', 'Heparin (units/hr)',
            'Norepinephrine STD 9 mg Dextrose 5% 250 ml (mcg/min)', 'Epinephrine drip (mcg/min)',
            'dopamine drip (mcg/kg/min)'][id % 27 + 1]
    END AS name,
    CASE WHEN id % 67 = 0 THEN '12.0625' WHEN id % 61 = 0 THEN '0.03125' WHEN id % 59 = 0 THEN '2.5'
         WHEN id % 53 = 0 THEN NULL WHEN id % 47 = 0 THEN '50 mcg' WHEN id % 43 = 0 THEN 'see note'
         WHEN id % 41 = 0 THEN 'UD' WHEN id % 37 = 0 THEN 'ERROR' WHEN id % 31 = 0 THEN ''
         WHEN id % 29 = 0 THEN 'OFF' ELSE (2 * ((id * 7) % 300) + 1)::VARCHAR END AS rate_text,
    (id % 10)::VARCHAR AS infusionrate, (id % 3)::VARCHAR AS drugamount,
    '250' AS volumeoffluid, NULL::VARCHAR AS patientweight
  FROM obs
),
drug_orders AS (
  SELECT stay,
    ['Epinephrine drip', 'EPINEPHrine 8 MG in 250 mL NS', 'Norepinephrine drip',
     'NOREPINEPHRINE 4 MG/250 ML NS', 'Epinephrine HCl', 'Norepinephrine in D5W',
     'NOREPINEPHRINE 4 MG IN 250 CC REPACKAGE Norepinephrine', 'Heparin'][id % 8 + 1] AS name,
    ['16 MG', '8 MG', '4 MG', NULL][id % 4 + 1] AS dosage,
    CASE WHEN id % 5 = 0 THEN 'Yes' WHEN id % 7 = 0 THEN NULL ELSE 'No' END AS cancelled,
    off AS start_off,
    CASE WHEN id % 23 <> 0 THEN off + 720 + 1440 * (id % 3) END AS stop_off
  FROM obs
),
careplan AS (
  SELECT id, stay, CASE WHEN id % 19 <> 0 THEN slot END AS off,
    CASE (id // 9) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS active,
    CASE WHEN id % 10 = 0 THEN 'Other' WHEN id % 2 = 1 THEN 'Airway' ELSE 'Ventilation' END AS grp,
    ['Intubated/oral ETT', 'Ventilated - with daily extubation evaluation', 'Non-invasive ventilation',
     'Intubated/trach-acute', 'Not intubated/normal airway', 'Spontaneous - adequate',
     'Spontaneous - tenuous', 'Ventilated - rapid wean/extubation', ''][id % 9 + 1] AS item
  FROM obs
),
cuff AS (
  SELECT id, stay, slot AS off, kind,
    CASE WHEN id % 13 = 0 OR id % 10 = 0 THEN NULL WHEN id % 17 = 0 THEN 0 ELSE top END AS s,
    CASE WHEN id % 13 = 0 OR id % 11 = 0 THEN NULL WHEN id % 17 = 0 THEN 0 ELSE top / 2 END AS d,
    CASE WHEN id % 13 = 0 OR id % 3 = 0 THEN NULL WHEN id % 17 = 0 THEN 0 ELSE v END AS m
  FROM (SELECT *, CASE WHEN id % 9 = 0 THEN v + 300 ELSE v END AS top FROM obs)
),
gases AS (
  SELECT id, stay, off, CASE WHEN id % 12 <> 0 THEN v + 40 END AS pao2,
         CASE WHEN id % 14 <> 0 THEN (21 + 10 * (id % 8)) / 100 END AS fio2
  FROM obs
),
measured AS (
  SELECT stay, off, 'gcs' AS what, (3 + id % 13)::DOUBLE AS x FROM obs WHERE id % 4 <> 0
  UNION ALL SELECT stay, if(id % 71 <> 0, off, NULL), 'bilirubin', ((id * 7) % 150) / 10 FROM obs WHERE id % 3 = 0
  UNION ALL SELECT stay, if(id % 71 <> 0, off, NULL), 'creatinine', ((id * 11) % 60) / 10 FROM obs WHERE id % 3 = 1
  UNION ALL SELECT stay, if(id % 71 <> 0, off, NULL), 'platelets', ((id * 13) % 400)::DOUBLE FROM obs WHERE id % 2 = 0
  UNION ALL SELECT stay, off, 'urine', ((id * 17) % 400)::DOUBLE FROM obs WHERE id % 6 <> 0
)
"""
