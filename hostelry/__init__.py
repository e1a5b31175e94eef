"""hostelry: hotel revenue and operations analytics as Spark DataFrame jobs.

Bronze JSON of guests, rooms, reservations, point-of-sale charges and
housekeeping logs is cleaned into silver tables (an SCD2 guest dimension, a
folio fact and a room-by-night calendar) and summarised into gold KPI tables.
Every step is a function from DataFrames to a DataFrame; only the writers in
``sources.tables`` and ``streaming`` touch storage.
"""

__version__ = "0.1.0"
