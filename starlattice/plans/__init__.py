"""The registered queries and the SQL each is checked against."""
