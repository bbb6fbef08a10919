"""Writers: tables, dumps, training sets, temperature labels."""
