"""Named queries of every operator and the SQL that checks them."""
