"""mendlake: bug-fix data sets on Spark.

From tables of commits, changed files, file contents and static-analysis
output to a content-deduplicated table of labelled before/after code pairs,
and from that table to filters, edits, exports, reports and training sets.
Every public function takes DataFrames or Columns and returns them.
"""
