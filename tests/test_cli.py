import argparse
import datetime as dt

import pytest

from procura.__main__ import _config


def _args(**kw):
    base = dict(statuses="1,21, 22", lob_ids="7", bu_codes="900,901", document_numbers=None,
                as_of="2030-06-01 00:00:00", precision=3, on_zero_divisor="null", dedupe_scope=False)
    base.update(kw)
    return argparse.Namespace(**base)


def test_config_from_script_parameters():
    cfg = _config(_args(document_numbers="PO-1001, PO-1002"))
    assert cfg.document_statuses == (1, 21, 22)
    assert cfg.bu_codes == (900, 901)
    assert cfg.document_numbers == ("PO-1001", "PO-1002")
    assert cfg.as_of == dt.datetime(2030, 6, 1)
    assert _config(_args()).document_numbers is None


def test_empty_list_item_is_rejected():
    with pytest.raises(ValueError):
        _config(_args(statuses="1,,21"))
