"""Named queries over the test tables, with SQL that checks them."""
