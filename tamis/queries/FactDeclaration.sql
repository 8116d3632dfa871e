-- Declared amount per year; IDPeriode starts with the four-digit year.
SELECT substring(IDPeriode, 1, 4) AS Year,
       sum(MontantDeclaration) AS TotalDeclaration
FROM FactDeclaration
GROUP BY ALL
ORDER BY Year
