"""The registered queries, the feeds they read and the SQL that checks them."""
