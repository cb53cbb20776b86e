import os
import tempfile
import time

from ledgerwatch.plans.store import Warehouse
from ledgerwatch.schemas import TRANSACTIONS_SCHEMA
from ledgerwatch.streaming.drops import run_available

HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _drop(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEAD + "".join(";".join(r) + "\n" for r in rows))


def test_stream_drop_loader_is_incremental(spark):
    drop = tempfile.mkdtemp(prefix="lw-sdrop-")
    wh = "file:" + tempfile.mkdtemp(prefix="lw-swh-")
    ckpt = "file:" + tempfile.mkdtemp(prefix="lw-sckpt-")
    _drop(drop, "transactions_01012024.txt", [("t1", "2024-01-01 10:00:00", "1", "C1", "p", "SUCCESS", "T1")])
    time.sleep(1.1)
    _drop(drop, "transactions_02012024.txt", [("t2", "2024-01-02 10:00:00", "2,5", "C1", "p", "SUCCESS", "T1"),
                                              ("t0", "2024-01-01 09:00:00", "1", "C1", "p", "SUCCESS", "T1")])
    _drop(drop, "notes.txt", [("x", "bad", "bad", "", "", "", "")])
    run_available(spark, drop, wh, ckpt)
    w = Warehouse(spark, wh)
    ids = sorted(r.trans_id for r in w.read_append("fact_transactions", TRANSACTIONS_SCHEMA).collect())
    assert ids == ["t1", "t2"]  # t0 is older than the first file's max
    assert w.watermark("fact_transactions") == "2024-01-02 10:00:00"

    time.sleep(1.1)
    _drop(drop, "transactions_03012024.txt", [("t3", "2024-01-03 10:00:00", "3", "C1", "p", "SUCCESS", "T1")])
    run_available(spark, drop, wh, ckpt)
    w = Warehouse(spark, wh)
    ids = sorted(r.trans_id for r in w.read_append("fact_transactions", TRANSACTIONS_SCHEMA).collect())
    assert ids == ["t1", "t2", "t3"]  # earlier files are not read again
