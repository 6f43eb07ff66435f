"""forgeline: star-schema processing for manufacturing and sales data on Spark.

Every public function takes and returns DataFrames (or Columns), so steps chain with
``df.transform``. Nothing here holds a global session.
"""
