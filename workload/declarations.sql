-- Declared amounts by year and insured group, by year alone and in all, with running totals
-- and the rank of each group in its year.
SELECT Year,
       NumImm,
       level,
       declared,
       round(sum(declared) OVER (PARTITION BY level, NumImm ORDER BY Year
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running,
       round(declared - lag(declared) OVER (PARTITION BY level, NumImm ORDER BY Year), 2) AS change,
       rank() OVER (PARTITION BY level, Year ORDER BY declared DESC) AS place
FROM (SELECT substring(CAST(IDPeriode AS STRING), 1, 4) AS Year,
             NumImm,
             CAST(GROUPING(NumImm) AS INT) AS level,
             round(sum(MontantDeclaration), 2) AS declared
      FROM FactDeclaration
      GROUP BY GROUPING SETS ((substring(CAST(IDPeriode AS STRING), 1, 4), NumImm),
                              (substring(CAST(IDPeriode AS STRING), 1, 4)))) AS totals
