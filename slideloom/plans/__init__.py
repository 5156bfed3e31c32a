"""The registered queries: what each operator does on the tables of a folder."""
