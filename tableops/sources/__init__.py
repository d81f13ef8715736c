from tableops.sources.files import scan, scan_csv, scan_files, scan_incremental, scan_json
from tableops.sources.jdbc import jdbc_options, scan_jdbc

__all__ = ["jdbc_options", "scan", "scan_csv", "scan_files", "scan_incremental", "scan_jdbc", "scan_json"]
