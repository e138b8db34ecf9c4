"""Named query plans: each entry builds a DataFrame from the test tables
(``catalog``) and has an independent DuckDB SQL formulation (``oracle``)
written from the reference's SQL semantics."""
