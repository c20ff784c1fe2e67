"""Compositions: the marts on the source tables (``fuelcard``, ``wholesale``),
the same patterns on the benchmark tables (``analogs``) with their SQL
(``oracle``), the checks report and the scheduled job."""
