"""Text and table analytics written as plain PySpark DataFrame functions."""
